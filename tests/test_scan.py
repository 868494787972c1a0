"""Running sums and neighbours over ranges against windows that hold a whole key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from care_episodes.functions.scan import PART, neighbours, ordered_parts, running_sums


@pytest.fixture(autouse=True)
def small_parts(spark):
    """Parts stay apart however small they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def skewed(spark, n=3000, seed=1):
    """A third of all rows on key 1, some on null, the rest spread."""
    rng = random.Random(seed)
    data = [(rng.choice([1, 1, 1, None, rng.randrange(200), rng.randrange(200)]), k, rng.choice([None, rng.randrange(-5, 9)])) for k in range(n)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k long, at long, v long")


@pytest.mark.parametrize("by", [["k"], []])
def test_sums_match_windows(spark, by):
    df = skewed(spark)
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.coalesce(F.bit_xor("v").over(w), F.lit(0)).alias("x"), F.count("*").over(w).alias("n"))
    parts = ordered_parts(df, by, ["at"])
    assert parts.select(PART).distinct().count() > 1
    got = running_sums(parts, by, ["at"], {"s": F.col("v"), "n": F.lit(1)}, {"x": F.col("v")}).select("k", "at", "v", "s", "x", "n")
    assert sorted(got.collect(), key=lambda r: r["at"]) == sorted(want.collect(), key=lambda r: r["at"])


@pytest.mark.parametrize("by", [["k"], []])
def test_neighbours_match_windows(spark, by):
    df = skewed(spark, seed=2)
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy("at")
    want = df.select("*", F.lag("v").over(w).alias("pv"), F.lag("at").over(w).alias("pa"), F.lead("at").over(w).alias("na"))
    got = neighbours(ordered_parts(df, by, ["at"]), by, ["at"], {"pv": "v", "pa": "at"}, {"na": "at"}).drop(PART)
    assert sorted(got.collect(), key=lambda r: r["at"]) == sorted(want.collect(), key=lambda r: r["at"])


def test_descending_order_and_no_rows(spark):
    df = skewed(spark).where("k is not null")
    parts = ordered_parts(df, [], [F.desc("at")])
    got = running_sums(parts, [], [F.desc("at")], {"n": F.lit(1)})
    assert {r["at"]: r["n"] for r in got.collect()} == {r["at"]: i + 1 for i, r in enumerate(sorted(df.collect(), key=lambda r: -r["at"]))}
    none = df.limit(0)
    assert running_sums(ordered_parts(none, ["k"], ["at"]), ["k"], ["at"], {"n": F.lit(1)}).collect() == []
