"""Summaries of episodes (A1-A3).  Grouped tables are small; shares are taken over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def share_of_total(count: str) -> Column:
    """Percent of the total of an already grouped table."""
    return F.col(count) / F.sum(count).over(Window.partitionBy(F.lit(1))) * 100


def overall_summary(episodes: DataFrame) -> DataFrame:
    """A1: episodes, persons, episodes per person."""
    return episodes.agg(
        F.count(F.lit(1)).alias("total_episodes"),
        F.count_distinct("person_id").alias("unique_persons"),
    ).withColumn("episodes_per_person", F.col("total_episodes") / F.col("unique_persons"))


def outcome_summary(episodes: DataFrame) -> DataFrame:
    """A1: number, percent and mean length by outcome."""
    grouped = episodes.groupBy("outcome_category").agg(
        F.count(F.lit(1)).alias("count"), F.avg("gestational_age_days").alias("avg_gest_days")
    )
    return grouped.withColumn("pct", share_of_total("count"))


def algorithm_summary(episodes: DataFrame) -> DataFrame:
    """A1: number and percent by source."""
    grouped = episodes.groupBy("algorithm_used").agg(F.count(F.lit(1)).alias("count"))
    return grouped.withColumn("pct", share_of_total("count"))


def length_summary(episodes: DataFrame) -> DataFrame:
    """A1: distribution of lengths.  Lengths are days below 321, so exact quantiles stay small."""
    days = F.col("gestational_age_days")
    quartiles = F.percentile(days, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return episodes.agg(
        F.min(days).alias("min_gest_days"),
        quartiles.alias("q"),
        F.avg(days).alias("mean_gest_days"),
        F.max(days).alias("max_gest_days"),
        F.stddev_samp(days).alias("sd_gest_days"),
    ).select(
        "min_gest_days",
        F.col("q")[0].alias("q1_gest_days"),
        F.col("q")[1].alias("median_gest_days"),
        "mean_gest_days",
        F.col("q")[2].alias("q3_gest_days"),
        "max_gest_days",
        "sd_gest_days",
    )


def year_summary(episodes: DataFrame) -> DataFrame:
    """A1: episodes by year of their end."""
    return episodes.groupBy(F.year("episode_end_date").alias("year")).agg(F.count(F.lit(1)).alias("count"))


def episode_summary(episodes: DataFrame) -> dict[str, DataFrame]:
    """A1: all summary tables."""
    return {
        "overall": overall_summary(episodes),
        "by_outcome": outcome_summary(episodes),
        "by_algorithm": algorithm_summary(episodes),
        "gestational_age": length_summary(episodes),
        "by_year": year_summary(episodes),
    }


def precision_summary(episodes: DataFrame) -> DataFrame:
    """A2: episodes by dating precision, most frequent first."""
    return (
        episodes.groupBy("precision_category").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "precision_category")
    )


def outcome_by_algorithm(episodes: DataFrame) -> DataFrame:
    """A2: episodes by outcome and source."""
    return (
        episodes.groupBy("outcome_category", "algorithm_used").agg(F.count(F.lit(1)).alias("n"))
        .orderBy("outcome_category", F.desc("n"))
    )


def person_summary(episodes: DataFrame) -> DataFrame:
    """A3: episodes, first start and last end of each person."""
    return episodes.groupBy("person_id").agg(
        F.count(F.lit(1)).alias("episodes"),
        F.min("episode_start_date").alias("first_episode"),
        F.max("episode_end_date").alias("last_episode"),
    )


def persons_overview(episodes: DataFrame) -> DataFrame:
    """A3: persons, mean and largest number of episodes per person."""
    return person_summary(episodes).agg(
        F.count(F.lit(1)).alias("persons"),
        F.avg("episodes").alias("mean_episodes"),
        F.max("episodes").alias("max_episodes"),
    )
