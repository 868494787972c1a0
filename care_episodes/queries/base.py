"""Registration of queries, and the stored stages that several of them start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from care_episodes import oracle
from care_episodes import testmap as tm
from care_episodes.operators.progression import daily_outcomes
from care_episodes.plans import pipeline
from care_episodes.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            oracle.QUERIES[name] = sql
        return query

    return add


def r6(col: str | Column, name: str | None = None) -> Column:
    """A double rounded for comparison across engines."""
    named = col if isinstance(col, str) else name
    return F.round(F.col(col) if isinstance(col, str) else col, 6).alias(name or named)


@dataclass
class Stages:
    """Stages of the pipeline on the mapped tables.  Each is stored once per session and folder,
    as a run of the pipeline does, and read by the queries on later stages."""

    spark: SparkSession
    sf_dir: str
    stored: dict[str, DataFrame] = field(default_factory=dict)

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A further table, stored at first use."""
        if name not in self.stored:
            self.stored[name] = materialize(build())
        return self.stored[name]

    @cached_property
    def rules(self):
        return tm.rules(self.spark)

    @cached_property
    def tables(self):
        return tm.tables(self.spark, self.sf_dir)

    @cached_property
    def cohort(self) -> pipeline.Cohort:
        return pipeline.extract_cohort(self.tables, self.rules, tm.CONFIG)

    @cached_property
    def outcomes(self) -> DataFrame:
        return daily_outcomes(self.cohort.events)

    @cached_property
    def hip(self) -> DataFrame:
        return materialize(pipeline.outcome_stage(self.cohort, self.rules, tm.CONFIG))

    @cached_property
    def pps(self) -> DataFrame:
        return materialize(pipeline.progression_stage(self.cohort, self.rules, tm.CONFIG))

    @cached_property
    def merged(self) -> DataFrame:
        return materialize(pipeline.merge_stage(self.hip, self.pps, self.cohort, tm.CONFIG))

    @cached_property
    def final(self) -> DataFrame:
        return materialize(pipeline.dating_stage(self.merged, self.cohort, self.rules, tm.CONFIG))


@lru_cache(maxsize=8)
def _stages(application: str, spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(spark, sf_dir)


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    return _stages(spark.sparkContext.applicationId, spark, sf_dir)
