"""Study statistics.

Sums run on Spark; what reaches the driver is the size of the model, not of the data: observed and
expected counts per group, or result rows.  Running sums and ranks along times and values go over ranges
(`functions/scan.py`): no task holds all of them.  Regression models (T5, T6) are in `regression.py`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from care_episodes.functions.scan import null_safe_join, ordered_parts, running_sums
from care_episodes.functions.special import chi_square_tail, poisson_interval
from care_episodes.session import materialize, small_table


# ---- T1 -------------------------------------------------------------------------------------
def table_one_categories(df: DataFrame, variables: Sequence[str], by: str | None = None) -> DataFrame:
    """Number and percent of each level, by group; missing values are counted apart.

    Percent is of the known values of the group.
    """
    group = [F.col(by).cast("string").alias("group")] if by else [F.lit("all").alias("group")]
    text = [F.col(v).cast("string").alias(v) for v in variables]
    long = df.select(*group, *text).unpivot("group", list(variables), "variable", "level")
    counts = long.groupBy("variable", "group", "level").agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("level").isNotNull(), F.col("n"))
    total = F.sum(known).over(Window.partitionBy("variable", "group"))
    return counts.withColumn("pct", known / total * 100)


def quantiles(df: DataFrame, by: Sequence[str], value: str, weight: str, at: Sequence[float]) -> DataFrame:
    """Exact quantiles (linear interpolation) of counted values by group: (by, n, q0, q1, ...).

    Values are dealt out by ranges and numbered by running sums; only those that hold a wanted rank are kept.  Null values don't count.
    """
    parts = ordered_parts(df.where(F.col(value).isNotNull()), by, [value])
    ranked = running_sums(parts, by, [value], {"_upto": F.col(weight)})
    totals = parts.groupBy(*by).agg(F.sum(weight).alias("n"))
    both = null_safe_join(ranked, totals, by, "inner")
    picked = []
    for k, q in enumerate(at):
        place = (F.col("n") - 1) * F.lit(float(q))
        low = F.floor(place)
        for name, rank in (("low", low), ("high", F.least(low + 1, F.col("n") - 1))):
            holds = (F.col("_upto") > rank) & (F.col("_upto") - F.col(weight) <= rank)
            picked.append(F.max(F.when(holds, F.col(value))).alias(f"_{name}{k}"))
    holders = both.groupBy(*by).agg(F.first("n").alias("n"), *picked)
    shares = [(F.col("n") - 1) * F.lit(float(q)) - F.floor((F.col("n") - 1) * F.lit(float(q))) for q in at]
    return holders.select(*by, "n", *[(F.col(f"_low{k}") + s * (F.col(f"_high{k}") - F.col(f"_low{k}"))).alias(f"q{k}") for k, s in enumerate(shares)])


def table_one_numbers(df: DataFrame, variables: Sequence[str], by: str | None = None) -> DataFrame:
    """Median, quartiles and missing count of numbers, by group.

    Equal values are counted before quantiles are taken from the counts.
    """
    group = [F.col(by).cast("string").alias("group")] if by else [F.lit("all").alias("group")]
    numbers = [F.col(v).cast("double").alias(v) for v in variables]
    long = df.select(*group, *numbers).unpivot("group", list(variables), "variable", "value")
    counts = materialize(long.groupBy("variable", "group", "value").agg(F.count(F.lit(1)).alias("count")))
    missing = counts.groupBy("variable", "group").agg(F.sum(F.when(F.col("value").isNull(), F.col("count")).otherwise(0)).alias("missing"))
    found = quantiles(counts, ["variable", "group"], "value", "count", (0.25, 0.5, 0.75))
    return null_safe_join(missing, found, ["variable", "group"], "left").select(
        "variable", "group", F.coalesce("n", F.lit(0)).alias("n"), "missing", F.col("q1").alias("median"), F.col("q0").alias("q1"), F.col("q2").alias("q3")
    )


# ---- T2, T3 ---------------------------------------------------------------------------------
def kaplan_meier(df: DataFrame, time: str, event: str, group: str) -> DataFrame:
    """Survival and cumulative incidence by group at each observed time.

    Rows are first counted by group and time; running sums go over ranges of time.
    """
    by_time = (
        df.filter(F.col(time).isNotNull() & F.col(event).isNotNull() & F.col(group).isNotNull())
        .groupBy(F.col(group).alias("group"), F.col(time).alias("time"))
        .agg(F.sum(F.col(event).cast("bigint")).alias("events"), F.count(F.lit(1)).alias("leaving"))
    )
    parts = ordered_parts(by_time, ["group"], [F.desc("time")])
    at_risk = running_sums(parts, ["group"], [F.desc("time")], {"at_risk": F.col("leaving")})
    # Nobody is left at the last time at most, so its step has no bearing on others.
    all_gone = F.col("events") == F.col("at_risk")
    step = F.when(~all_gone, F.log1p(-F.col("events") / F.col("at_risk")))
    steps = materialize(at_risk.withColumns({"step": step, "all_gone": all_gone}))
    totals = steps.groupBy("group").agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("total"))
    later = running_sums(steps, ["group"], [F.desc("time")], {"from_here": F.col("step")}).join(totals, "group")
    so_far = F.col("total") - F.col("from_here") + F.coalesce("step", F.lit(0.0))
    survival = F.when(F.col("all_gone"), 0.0).otherwise(F.exp(so_far))
    return later.select(
        "group", "time", "at_risk", "events", (F.col("leaving") - F.col("events")).alias("censored"),
        survival.alias("survival"), (1 - survival).alias("cumulative_incidence"),
    )


def risk_table(df: DataFrame, time: str, group: str, at: Sequence[float]) -> DataFrame:
    """Persons still at risk at given times."""
    known = df.filter(F.col(time).isNotNull() & F.col(group).isNotNull())
    counts = [F.count_if(F.col(time) >= t).alias(f"at_{t:g}") for t in at]
    return known.groupBy(F.col(group).alias("group")).agg(*counts)


def _group_values(df: DataFrame, group: str) -> list:
    """The groups of the test, a handful: each is a row and a column of the covariance, whose cells are the columns of one aggregate."""
    return sorted(r[0] for r in df.select(group).filter(F.col(group).isNotNull()).distinct().collect())


def _log_rank_sums(df: DataFrame, time: str, event: str, group: str) -> tuple[list, dict]:
    values = _group_values(df, group)
    counts = []
    for i, v in enumerate(values):
        mine = F.col(group) == v
        counts += [
            F.sum(F.when(mine, F.col(event)).otherwise(0).cast("bigint")).alias(f"d{i}"),
            F.count_if(mine).alias(f"l{i}"),
        ]
    by_time = df.filter(F.col(time).isNotNull() & F.col(group).isNotNull()).groupBy(time).agg(*counts)
    k = range(len(values))
    parts = ordered_parts(by_time, [], [F.desc(time)])
    risk = running_sums(parts, [], [F.desc(time)], {f"n{i}": F.col(f"l{i}") for i in k})
    n = sum((F.col(f"n{i}") for i in k), F.lit(0))
    d = sum((F.col(f"d{i}") for i in k), F.lit(0))
    tables = risk.withColumns({"n": n, "d": d}).filter("d > 0")
    spread = F.when(F.col("n") > 1, F.col("d") * (F.col("n") - F.col("d")) / (F.col("n") - 1)).otherwise(0.0)
    sums = []
    for i in k:
        share = F.col(f"n{i}") / F.col("n")
        sums += [F.sum(f"d{i}").alias(f"o{i}"), F.sum(F.col("d") * share).alias(f"e{i}")]
        for j in k:
            other = F.lit(1.0 if i == j else 0.0) - F.col(f"n{j}") / F.col("n")
            sums.append(F.sum(spread * share * other).alias(f"v{i}_{j}"))
    row = tables.agg(*sums).first().asDict()
    return values, {name: float(value or 0) for name, value in row.items()}


def log_rank(df: DataFrame, time: str, event: str, group: str) -> DataFrame:
    """Observed and expected events by group, with the statistic and p-value of the test."""
    values, s = _log_rank_sums(df, time, event, group)
    k = len(values)
    gap = np.array([s[f"o{i}"] - s[f"e{i}"] for i in range(k - 1)])
    var = np.array([[s[f"v{i}_{j}"] for j in range(k - 1)] for i in range(k - 1)])
    chisq = float(gap @ np.linalg.solve(var, gap)) if k > 1 else 0.0
    p = chi_square_tail(chisq, k - 1) if k > 1 else 1.0
    rows = [(str(v), s[f"o{i}"], s[f"e{i}"], chisq, k - 1, p) for i, v in enumerate(values)]
    schema = "group string, observed double, expected double, chisq double, df int, p_value double"
    return small_table(df.sparkSession, rows, schema)


# ---- T4 -------------------------------------------------------------------------------------
def incidence_rate(df: DataFrame, event: str, years: str, by: Sequence[str]) -> DataFrame:
    """T4: events, person-years and rate per 1000 person-years."""
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col(event) == 1, 1).otherwise(0)).cast("bigint").alias("events"),
            F.sum(years).alias("person_years"),
        )
        .withColumn("rate_per_1000", F.try_divide(F.col("events") * 1000.0, F.col("person_years")))
    )


def incidence_rate_ci(rates: DataFrame, level: float = 0.95) -> DataFrame:
    """T4: exact Poisson limits for the rows of a rate table, however many there are."""

    def limits(batches):
        for rows in batches:
            bounds = [poisson_interval(float(e), level) for e in rows["events"]]
            years = rows["person_years"].where(rows["person_years"] != 0)
            yield rows.assign(rate_low=[b[0] for b in bounds] / years * 1000, rate_high=[b[1] for b in bounds] / years * 1000)

    schema = StructType([*rates.schema.fields, StructField("rate_low", DoubleType()), StructField("rate_high", DoubleType())])
    return rates.mapInPandas(limits, schema)


# ---- T7 -------------------------------------------------------------------------------------
def exposure_tables(df: DataFrame, exposure: str, variables: Sequence[str]) -> DataFrame:
    """Exposure by each 0/1 variable."""
    long = df.select(
        F.col(exposure).alias("exposure"), *[F.col(v).cast("int").alias(v) for v in variables]
    ).unpivot("exposure", list(variables), "variable", "value")
    return long.groupBy("variable", "value", "exposure").agg(F.count(F.lit(1)).alias("n"))


def events_per_variable(df: DataFrame, variables: dict[str, int]) -> DataFrame:
    """Events of each variable divided by the number of predictors planned for its model."""
    counts = df.agg(*[F.count_if(F.col(v) == 1).alias(v) for v in variables])
    predictors = F.create_map(*[F.lit(part) for v, n in variables.items() for part in (v, n)])
    return (
        counts.unpivot([], list(variables), "variable", "events")
        .withColumn("predictors", predictors[F.col("variable")])
        .withColumn("events_per_variable", F.col("events") / F.col("predictors"))
    )
