"""Running sums and neighbours along an order that no single task has to hold.

A window needs all rows of a partition key in one task.  Where a key (or the whole table) may hold more rows than that, the order
is cut into ranges instead: rows are dealt out by range and written once with the number of their part, each part is summed on
its own, and what stands before a part is summed over the parts of its key (a row per part).

Rows equal in key and order fall into one part; count them first where there may be many.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from care_episodes.session import materialize

PART = "_part"


def ordered_parts(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], cut: Sequence[Column | str] | None = None) -> DataFrame:
    """`df` dealt into ranges of (by, order) numbered by `_part`, written once.

    `cut` may name a coarser order to cut by (prefixes of the order's columns, or shorter forms of them that sort alike).
    """
    ranged = df.repartitionByRange(*by, *(order if cut is None else cut))
    return materialize(ranged.withColumn(PART, F.spark_partition_id()))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, hint: str | None = None) -> DataFrame:
    """Join on equal columns, null equal to null; the right side's copies of them go.  `hint` goes to the right side."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed.hint(hint) if hint else renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def day_parts(df: DataFrame, by: Sequence[str], day: Column) -> DataFrame:
    """`df` with the day as its `_part`: for rows in the order of days, where the calendar bounds the parts of a key.

    Nothing is written; windows and totals share one shuffle by (key, day).
    """
    return df.withColumn(PART, day).repartition(*by, PART)


def _inside(by: Sequence[str], order: Sequence[Column | str]) -> WindowSpec:
    return Window.partitionBy(*by, PART).orderBy(*order)


def _with_taken_over(parts: DataFrame, by: Sequence[str], totals: Mapping[str, Column], over: Mapping[str, Column]) -> DataFrame:
    """Joins to each row what its key's other parts hand over.

    `totals` are aggregates of a part; `over` combines those of other parts, in a window in the order of parts.
    """
    per_part = parts.groupBy(*by, PART).agg(*[c.alias(n) for n, c in totals.items()])
    in_order = Window.partitionBy(*by).orderBy(PART)
    taken = per_part.select(*by, PART, *[c(in_order).alias(n) for n, c in over.items()])
    some = F.lit(False)
    for n in over:
        some = some | F.col(n).isNotNull()
    # A row per key and part: with persons as keys too many to broadcast, whatever their files weigh.
    return null_safe_join(parts, taken.where(some), [*by, PART], "left", "merge")


def running_sums(
    parts: DataFrame, by: Sequence[str], order: Sequence[Column | str], sums: Mapping[str, Column], xors: Mapping[str, Column] | None = None
) -> DataFrame:
    """Adds running sums (and exclusive-ors) up to and with each row, along the order the parts were made with.  Nulls add nothing."""
    xors = xors or {}
    up_to = _inside(by, order).rowsBetween(Window.unboundedPreceding, 0)
    totals = {f"_t_{n}": F.sum(c) for n, c in sums.items()} | {f"_t_{n}": F.bit_xor(c) for n, c in xors.items()}

    def earlier(how, name):
        return lambda w: how(f"_t_{name}").over(w.rowsBetween(Window.unboundedPreceding, -1))

    over = {f"_b_{n}": earlier(F.sum, n) for n in sums} | {f"_b_{n}": earlier(F.bit_xor, n) for n in xors}
    both = _with_taken_over(parts, by, totals, over)

    def before(name):
        return F.coalesce(F.col(f"_b_{name}"), F.lit(0))

    added = {n: F.coalesce(F.sum(c).over(up_to), F.lit(0)) + before(n) for n, c in sums.items()}
    added |= {n: F.coalesce(F.bit_xor(c).over(up_to), F.lit(0)).bitwiseXOR(before(n)) for n, c in xors.items()}
    return both.select(*parts.columns, *[c.alias(n) for n, c in added.items()])


def neighbours(
    parts: DataFrame, by: Sequence[str], order: Sequence[Column | str], previous: Mapping[str, str], following: Mapping[str, str] | None = None
) -> DataFrame:
    """Adds columns of the row before ({new: column}) and after, along the order the parts were made with.

    The order must be total within a key: no two rows equal in it.
    """
    following = following or {}
    inside = _inside(by, order)
    totals, over = {}, {}
    if previous:
        totals["_t_last"] = F.max_by(F.struct(*set(previous.values())), F.struct(*order))
        over["_b_last"] = lambda w: F.lag("_t_last").over(w)
    if following:
        totals["_t_first"] = F.min_by(F.struct(*set(following.values())), F.struct(*order))
        over["_b_first"] = lambda w: F.lead("_t_first").over(w)
    both = _with_taken_over(parts, by, totals, over)
    added = {n: F.when(F.lag(F.lit(1)).over(inside).isNull(), F.col("_b_last")[c]).otherwise(F.lag(c).over(inside)) for n, c in previous.items()}
    added |= {n: F.when(F.lead(F.lit(1)).over(inside).isNull(), F.col("_b_first")[c]).otherwise(F.lead(c).over(inside)) for n, c in following.items()}
    return both.select(*parts.columns, *[c.alias(n) for n, c in added.items()])
