"""Comparing episodes with a registry of known pregnancies (V1-V9)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.functions.dates import day_of
from care_episodes.functions.fixed_values import REPORT_ORDER
from care_episodes.functions.primitives import join_growing, points_in_intervals
from care_episodes.functions.rules import is_in
from care_episodes.functions.scan import PART, neighbours, ordered_parts, running_sums
from care_episodes.session import materialize, small_table

PREDICTION_COLUMNS = (
    "person_id", "episode_number", "episode_start_date", "episode_end_date", "outcome_category",
    "gestational_age_days", "algorithm_used", "precision_category",
)


def load_predictions(df: DataFrame) -> DataFrame:
    """V1: distinct predictions; dates come from the merged copy (`_x`) where the first is empty."""
    df = df.toDF(*[c.lower() for c in df.columns])

    def either(name: str) -> Column:
        both = [F.col(c).cast("date") for c in (name, f"{name}_x") if c in df.columns]
        return F.coalesce(*both).alias(name)

    return df.select(
        F.col("person_id").cast("bigint").alias("person_id"), "episode_number",
        either("episode_start_date"), either("episode_end_date"), "outcome_category",
        F.col("gestational_age_days").cast("int").alias("gestational_age_days"),
        "algorithm_used", "precision_category",
    ).distinct()


def link_ids(registry_to_cohort: DataFrame, cohort_to_person: DataFrame) -> DataFrame:
    """V2: registry id to person id."""
    return join_growing(registry_to_cohort, cohort_to_person, "cohort_id").select("emrn", "person_id").distinct()


def linkage_overlap(
    predictions: DataFrame, pregnancies: DataFrame, registry_to_cohort: DataFrame, linkage: DataFrame
) -> DataFrame:
    """V2: how many ids of each side are known to the other, one row per check."""

    def check(name: str, ids: DataFrame, known: DataFrame) -> DataFrame:
        key = ids.columns[0]
        ids, known = ids.distinct(), known.distinct().withColumn("found", F.lit(1))
        return join_growing(ids, known, key, "left").agg(
            F.lit(name).alias("check"), F.count(F.lit(1)).alias("ids"), F.count("found").alias("known")
        )

    return check("registry ids in id table", pregnancies.select("emrn"), registry_to_cohort.select("emrn")).unionByName(
        check("predicted persons in linkage", predictions.select("person_id"), linkage.select("person_id"))
    )


def derive_registry_outcome(pregnancies: DataFrame, deliveries: DataFrame, linkage: DataFrame) -> DataFrame:
    """V3: outcome of each registry pregnancy from the change of the running counts.

    Delivery facts are the first known ones of the mother (by `delivery_id`).
    """

    def first_known(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("delivery_id"))).alias(name)

    mothers = deliveries.groupBy("emrn").agg(
        first_known("gestational_age_days"), first_known("born_alive"), first_known("living_status")
    )
    counts = ("para", "abortion", "therapeutic", "spontaneous", "ectopic")
    order = ["gravida_count", "emrn"]
    known = join_growing(pregnancies, linkage, "emrn")
    previous = {"prev_emrn": "emrn"} | {f"prev_{c}": f"{c}_count" for c in counts}
    in_order = neighbours(ordered_parts(known, ["person_id"], order), ["person_id"], order, previous)

    def change(name: str) -> Column:
        return F.col(f"{name}_count") - F.when(F.col("prev_emrn").isNull(), 0).otherwise(F.col(f"prev_{name}"))

    changes = {f"d_{c}": change(c) for c in counts}
    delivered = F.col("d_para") > 0
    no_birth = F.lower("living_status").isin("stillborn", "fetal demise")
    outcome = (
        F.when(delivered & (F.col("born_alive") == 1), "LB")
        .when(delivered & (F.col("born_alive") == 0), "SB")
        .when(delivered & no_birth, "SB")
        .when(F.col("d_ectopic") > 0, "ECT")
        .when(F.col("d_therapeutic") > 0, "AB")
        .when(F.col("d_spontaneous") > 0, "SA")
        .when((F.col("d_abortion") > 0) & (F.col("d_therapeutic") == 0) & (F.col("d_spontaneous") == 0), "AB")
        .when(delivered, "DELIV")
        .otherwise("PREG")
    )
    return (
        join_growing(in_order, mothers, "emrn", "left")
        .withColumns(changes)
        .select(
            "person_id", "emrn", F.col("gravida_count").alias("gt_episode_num"),
            F.col("estimated_start").alias("gt_start"), F.col("estimated_end").alias("gt_end"),
            outcome.alias("gt_outcome"), F.col("gestational_age_days").alias("gt_ga_days"),
            "born_alive", "living_status",
        )
    )


@dataclass
class MatchResult:
    """Matched pairs, both leftovers and the counts of a comparison (V4)."""

    matched: DataFrame
    unmatched_predicted: DataFrame
    unmatched_registry: DataFrame
    by_date: bool

    def stats(self) -> DataFrame:
        """V4: totals and match rates, one row."""
        parts = {
            "matched": self.matched,
            "unmatched_algo": self.unmatched_predicted,
            "unmatched_gt": self.unmatched_registry,
        }
        rows = None
        for name, df in parts.items():
            extra = [F.lit(0).cast("bigint").alias("registry_matched")]
            if name == "matched":
                extra = [F.count_distinct("person_id", "gt_episode_num").alias("registry_matched")]
            row = df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), *extra)
            rows = row if rows is None else rows.unionByName(row)

        def of(part: str, col: str = "n") -> Column:
            return F.sum(F.when(F.col("part") == part, F.col(col)).otherwise(0))

        return (
            rows.agg(
                of("matched").alias("matched"),
                of("unmatched_algo").alias("unmatched_algo"),
                of("unmatched_gt").alias("unmatched_gt"),
                (of("matched") + of("unmatched_algo")).alias("total_algo"),
                (of("matched", "registry_matched") + of("unmatched_gt")).alias("total_gt"),
            )
            .withColumn("match_rate_algo", F.col("matched") / F.col("total_algo"))
            .withColumn("match_rate_gt", F.col("matched") / F.col("total_gt"))
        )


def match_episodes(predictions: DataFrame, registry: DataFrame, window_days: int = 30) -> MatchResult:
    """V4: each predicted episode with its best registry pregnancy.

    Best is the closest end date within the window.  If no end date of the whole input is that
    close (dates shifted per person), the k-th episodes of a person are matched instead.
    """
    algo = predictions.select(
        "person_id",
        F.col("episode_number").alias("algo_episode_num"),
        F.col("episode_start_date").alias("algo_start"),
        F.col("episode_end_date").alias("algo_end"),
        F.col("outcome_category").alias("algo_outcome"),
        F.col("gestational_age_days").alias("algo_ga_days"),
        F.col("algorithm_used").alias("algo_method"),
    )
    gt = registry.select("person_id", "gt_episode_num", "gt_start", "gt_end", "gt_outcome", "gt_ga_days")
    low, high = day_of(F.col("algo_end")) - window_days, day_of(F.col("algo_end")) + window_days
    near = points_in_intervals(
        algo.filter("algo_end IS NOT NULL"),
        gt.filter("gt_end IS NOT NULL").withColumn("gt_day", day_of(F.col("gt_end"))),
        ["person_id"], low, high, "gt_day", 4 * window_days + 1,
    ).withColumn("end_date_diff", F.datediff("algo_end", "gt_end"))
    found = ["gt_end", "gt_episode_num", "gt_start", "gt_outcome", "gt_ga_days", "end_date_diff"]
    best = F.min(F.struct(F.abs("end_date_diff").alias("apart"), *found)).alias("best")
    nearest = near.groupBy(*algo.columns).agg(best).select(*algo.columns, *[f"best.{c}" for c in found])
    matched = materialize(nearest)
    by_date = not matched.isEmpty()
    if not by_date:
        matched = materialize(_match_in_order(algo, gt))
    return MatchResult(
        matched=matched,
        unmatched_predicted=join_growing(algo, matched, ["person_id", "algo_episode_num"], "left_anti"),
        unmatched_registry=join_growing(gt, matched, ["person_id", "gt_episode_num"], "left_anti"),
        by_date=by_date,
    )


def _match_in_order(algo: DataFrame, gt: DataFrame) -> DataFrame:
    """The k-th predicted episode of a person with the k-th registry pregnancy, by end date."""
    def numbered(df: DataFrame, *order: str) -> DataFrame:
        in_order = running_sums(ordered_parts(df, ["person_id"], order), ["person_id"], order, {"algo_order": F.lit(1)})
        return in_order.withColumn("algo_order", F.col("algo_order").cast("int")).drop(PART)

    pairs = join_growing(
        numbered(algo, "algo_end", "algo_episode_num"), numbered(gt, "gt_end", "gt_episode_num"), ["person_id", "algo_order"]
    )
    return pairs.withColumn("end_date_diff", F.lit(None).cast("int"))


def confusion_matrix(matched: DataFrame) -> DataFrame:
    """V5: matched episodes by both outcomes, all 7 x 7 cells."""
    cells = small_table(
        matched.sparkSession, [(a, g) for a in REPORT_ORDER for g in REPORT_ORDER], "algo_outcome string, gt_outcome string"
    )
    counts = matched.groupBy("algo_outcome", "gt_outcome").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(counts, ["algo_outcome", "gt_outcome"], "left").fillna(0, ["n"])


def classification_metrics(matched: DataFrame) -> DataFrame:
    """V6: precision, recall and F1 of each outcome.

    Episodes are counted per cell once; each cell then adds to its row and column category.
    """
    cells = confusion_matrix(matched)
    hit = F.col("algo_outcome") == F.col("gt_outcome")
    roles = F.when(hit, F.array(F.struct(F.col("gt_outcome").alias("category"), F.lit("tp").alias("role")))).otherwise(
        F.array(
            F.struct(F.col("algo_outcome").alias("category"), F.lit("fp").alias("role")),
            F.struct(F.col("gt_outcome").alias("category"), F.lit("fn").alias("role")),
        )
    )

    def total(role: str, name: str) -> Column:
        return F.sum(F.when(F.col("r.role") == role, F.col("n")).otherwise(0)).alias(name)

    counted = (
        cells.withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(1))))
        .withColumn("r", F.explode(roles))
        .groupBy(F.col("r.category").alias("category"))
        .agg(
            total("tp", "true_positive"), total("fp", "false_positive"), total("fn", "false_negative"),
            F.max("total").alias("total"),
        )
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return counted.select(
        "category", "true_positive", "false_positive", "false_negative",
        (F.col("total") - tp - fp - fn).alias("true_negative"),
        precision.alias("precision"), recall.alias("recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1_score"),
        (tp + fn).alias("support"),
    )


def overall_accuracy(matched: DataFrame) -> DataFrame:
    """V6: share of matched episodes with the same outcome."""
    return matched.agg(
        F.count(F.lit(1)).alias("total_matched"),
        F.count_if(F.col("algo_outcome") == F.col("gt_outcome")).alias("total_correct"),
    ).withColumn("overall_accuracy", F.try_divide("total_correct", "total_matched"))


def _with_ga(matched: DataFrame, low: int, high: int) -> DataFrame:
    both = F.col("algo_ga_days").between(low, high) & F.col("gt_ga_days").between(low, high)
    return matched.filter(both).withColumn("d", (F.col("algo_ga_days") - F.col("gt_ga_days")).cast("double"))


def _within(days: int) -> Column:
    return (F.avg((F.abs("d") <= days).cast("double")) * 100).alias(f"pct_within_{days}d")


def ga_agreement(matched: DataFrame, low: int = 0, high: int = 320) -> DataFrame:
    """V7: agreement of gestational ages, with Bland-Altman limits.  One row."""
    return (
        _with_ga(matched, low, high)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("d").alias("mean_diff"),
            F.percentile("d", 0.5).alias("median_diff"),
            F.stddev_samp("d").alias("sd_diff"),
            F.avg(F.abs("d")).alias("mae"),
            F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmse"),
            _within(7), _within(14), _within(21),
            F.corr(F.col("algo_ga_days").cast("double"), F.col("gt_ga_days").cast("double")).alias("correlation"),
        )
        .withColumn("lower_limit", F.col("mean_diff") - 1.96 * F.col("sd_diff"))
        .withColumn("upper_limit", F.col("mean_diff") + 1.96 * F.col("sd_diff"))
    )


def ga_agreement_by_outcome(matched: DataFrame, low: int = 0, high: int = 320) -> DataFrame:
    """V7: the same by registry outcome."""
    return _with_ga(matched, low, high).groupBy("gt_outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("d").alias("mean_diff"),
        F.percentile("d", 0.5).alias("median_diff"),
        F.avg(F.abs("d")).alias("mae"),
        _within(7), _within(14),
    )


def person_counts(predictions: DataFrame, registry: DataFrame) -> DataFrame:
    """V8: episodes per person and class on both sides, zero where a side knows nothing."""

    def counts(df: DataFrame, outcome: str, p: str) -> DataFrame:
        o = F.col(outcome)
        return df.groupBy("person_id").agg(
            F.count(F.lit(1)).alias(f"{p}_total"),
            F.count_if(o == "LB").alias(f"{p}_lb"),
            F.count_if(o == "SB").alias(f"{p}_sb"),
            F.count_if(is_in(o, ("AB", "SA"))).alias(f"{p}_ab"),
            F.count_if(o == "ECT").alias(f"{p}_ect"),
        )

    both = join_growing(
        counts(predictions, "outcome_category", "algo"), counts(registry, "gt_outcome", "gt"), "person_id", "full"
    ).fillna(0)
    return both.withColumns(
        {
            "total_diff": F.col("algo_total") - F.col("gt_total"),
            "lb_match": F.col("algo_lb") == F.col("gt_lb"),
            "ab_match": F.col("algo_ab") == F.col("gt_ab"),
        }
    )


def person_agreement(counts: DataFrame) -> DataFrame:
    """V8: agreement of the number of episodes per person.  One row."""
    diff = F.col("total_diff")
    algo, gt = F.col("algo_total") > 0, F.col("gt_total") > 0

    def percent(cond: Column) -> Column:
        return F.avg(cond.cast("double")) * 100

    return counts.agg(
        F.count(F.lit(1)).alias("n_persons"),
        F.count_if(algo & ~gt).alias("n_algo_only"),
        F.count_if(gt & ~algo).alias("n_gt_only"),
        F.count_if(gt & algo).alias("n_both"),
        percent(diff == 0).alias("pct_exact_total_match"),
        percent(F.col("lb_match")).alias("pct_lb_match"),
        percent(F.col("ab_match")).alias("pct_ab_match"),
        F.avg(diff).alias("mean_total_diff"),
        F.percentile(diff, 0.5).alias("median_total_diff"),
        F.count_if(diff > 0).alias("n_over_count"),
        F.count_if(diff < 0).alias("n_under_count"),
        F.count_if(diff == 0).alias("n_exact"),
    )


def validation_summary(result: MatchResult, predictions: DataFrame, registry: DataFrame) -> DataFrame:
    """V9: the headline numbers as (metric, value); rates are percentages."""
    def rows(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        wide = df.select(*[c.cast("double").alias(n) for n, c in metrics.items()])
        return wide.unpivot([], list(metrics), "metric", "value")

    c = F.col
    parts = [
        rows(result.stats(), {
            "Algorithm episodes": c("total_algo"), "Ground truth episodes": c("total_gt"),
            "Matched episodes": c("matched"), "Algorithm match rate": c("match_rate_algo") * 100,
            "Ground truth match rate": c("match_rate_gt") * 100,
        }),
        rows(overall_accuracy(result.matched), {"Overall classification accuracy": c("overall_accuracy") * 100}),
        rows(ga_agreement(result.matched), {
            "Mean GA difference (days)": c("mean_diff"), "GA within 7 days": c("pct_within_7d"),
            "GA within 14 days": c("pct_within_14d"),
        }),
        rows(person_agreement(person_counts(predictions, registry)), {
            "Person exact count match": c("pct_exact_total_match"),
        }),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("value", F.round("value", 1))
