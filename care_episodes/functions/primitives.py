"""Building blocks shared by the episode operators.

Data volume per person is not limited by anything in a source: one person (a test account, a
default id) may own a third of all rows.  Every operator that needs the records of a person in
order therefore first aggregates them to one row per person and day (and value).  Those
aggregates combine on the map side, spread over (person, day, ...) in the shuffle, and leave at
most one row per calendar day and value, so the window that follows is bounded by the calendar
and not by the input.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(*order: str | Column, by: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def number_groups(starts: Column, by: list[str], *order: str | Column) -> Column:
    """Running number of the group that each row belongs to, given the rows that start one."""
    return F.sum(F.when(starts, 1).otherwise(0)).over(running(*order, by=by)).cast("int")


def neighbour_rule(
    prev_category: Column,
    prev_gap: Column,
    next_category: Column,
    next_gap: Column,
    before: Mapping[str, int],
    after: Mapping[str, int],
) -> Column:
    """Keep a lower-ranked episode next to higher-ranked ones.

    A neighbour blocks if its category is in the table.  Kept when no neighbour blocks, when one
    blocks far enough away and the other side is empty, or when both block far enough away.  A
    blocking neighbour beside a present but non-blocking one drops the episode.
    """

    def side(category: Column, gap: Column, limits: Mapping[str, int]) -> tuple[Column, Column]:
        blocks, far = F.lit(False), F.lit(False)
        for name, days in limits.items():
            blocks = blocks | (category == name)
            far = far | ((category == name) & (gap >= days))
        return F.coalesce(blocks, F.lit(False)), F.coalesce(far, F.lit(False))

    prev_blocks, prev_far = side(prev_category, prev_gap, before)
    next_blocks, next_far = side(next_category, next_gap, after)
    return (
        (~prev_blocks & ~next_blocks)
        | (prev_far & next_category.isNull())
        | (next_far & prev_category.isNull())
        | (prev_far & next_far)
    )


def join_growing(left: DataFrame, right: DataFrame, on: Column | str | list[str], how: str = "inner") -> DataFrame:
    """Join of two tables that both grow with the input: sorted and merged, never broadcast.

    The size that Spark compares with its broadcast limit is that of the files.  Keys and dates are
    a small part of it on disk and many times more as rows, all of which a broadcast would hold
    on the driver.  Code lists and other tables of fixed size use a plain join.
    """
    return left.join(right.hint("merge"), on, how)


def points_in_intervals(
    intervals: DataFrame,
    points: DataFrame,
    keys: list[str],
    low: Column,
    high: Column,
    point: str,
    bucket_days: int,
    how: str = "inner",
) -> DataFrame:
    """Join day points into day intervals of the same keys.

    Both sides meet on (keys, time bucket): an interval is listed once per bucket it touches, a
    point has one bucket, so each pair meets exactly once.  That bounds the pairs looked at by
    the interval length, and splits a person with very many rows over many join keys.

    With how='left' an interval comes back once per bucket even without points, and once if a
    bound is empty; the callers group by interval afterwards, which folds those rows together.
    """
    bucket = "_bucket"
    left = intervals.withColumn("_low", low).withColumn("_high", high)
    first = F.floor(F.col("_low") / bucket_days)
    last = F.floor(F.col("_high") / bucket_days)
    listed = left.withColumn(
        bucket, (F.explode_outer if how == "left" else F.explode)(F.sequence(first, F.greatest(first, last)))
    )
    right = points.withColumn(bucket, F.floor(F.col(point) / bucket_days))
    renamed = [(k, f"_p_{k}") for k in keys] + [(bucket, f"_p{bucket}")]
    for old, new in renamed:
        right = right.withColumnRenamed(old, new)
    on = (F.col(point) >= F.col("_low")) & (F.col(point) <= F.col("_high"))
    for old, new in renamed:
        on = on & (F.col(old) == F.col(new))
    joined = join_growing(listed, right, on, how)
    return joined.drop(bucket, "_low", "_high", *[new for _, new in renamed])


def best_point(
    rows: DataFrame, points: DataFrame, keys: list[str], at: str, point: str, order: Column, side: str, bucket_days: int = 366
) -> DataFrame:
    """Adds `best` to each row: the least `order` (a struct in columns of `points`) among its key's points on or before, or on or after, `at`.

    Time is cut into buckets.  The best point of all buckets further on is carried to each bucket that holds a row or a point, in a window
    over the key's buckets, which the calendar bounds.  A row then looks at that one value and at the points of its own bucket:
    points should be one per day.  Rows of equal key and `at` come back once.
    """
    bucket = "_bucket"
    listed = rows.select(*keys, at).distinct().withColumn(bucket, F.floor(F.col(at) / bucket_days))
    valued = points.select(*keys, F.col(point).alias("_point"), order.alias("_order")).withColumn(bucket, F.floor(F.col("_point") / bucket_days))
    own = valued.groupBy(*keys, bucket).agg(F.min("_order").alias("_own"))
    every = own.unionByName(listed.select(*keys, bucket).distinct(), allowMissingColumns=True).groupBy(*keys, bucket).agg(F.min("_own").alias("_own"))
    in_order = Window.partitionBy(*keys).orderBy(F.desc(bucket) if side == "after" else F.asc(bucket))
    carried = every.select(*keys, bucket, F.min("_own").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    near = (F.col("_point") >= F.col(at)) if side == "after" else (F.col("_point") <= F.col(at))
    inside = join_growing(listed, valued, [*keys, bucket]).where(near).groupBy(*keys, at).agg(F.min("_order").alias("_near"))
    return (
        join_growing(join_growing(listed, carried, [*keys, bucket]), inside, [*keys, at], "left")
        .withColumn("best", F.least("_carried", "_near")).drop(bucket, "_carried", "_near")
    )


def clip_to_previous(df: DataFrame, start: str, end: str, *ties: str | Column) -> DataFrame:
    """Move a start that lies on or before the previous end to the day after that end.

    Adds `_start` (clipped).  The previous end is the recorded one, whether or not the previous
    row survives the caller's filter.
    """
    order = Window.partitionBy("person_id").orderBy(start, *ties)
    prev_end = F.lag(end).over(order)
    return df.withColumn(
        "_start", F.when(prev_end >= F.col(start), prev_end + 1).otherwise(F.col(start))
    )


def quartile_bounds(values: Column, counts: Column, over: Window) -> tuple[Column, Column]:
    """First and third quartile (linear interpolation) of counted values over a window."""
    both = F.percentile(values, F.array(F.lit(0.25), F.lit(0.75)), counts).over(over)
    return both[0], both[1]
