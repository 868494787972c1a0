"""Time the headline queries: one warm-up, then the median of the timed runs.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from care_episodes import testmap as tm  # noqa: E402
from care_episodes.operators import regression, stats, study  # noqa: E402
from care_episodes.plans import pipeline  # noqa: E402
from care_episodes.queries import study as study_queries  # noqa: E402
from care_episodes.queries.base import Stages  # noqa: E402
from care_episodes.session import local_session, materialize  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


#: Copies of the clinical tables, each with persons of its own, and the timed names (all unless given).
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]


def copied(table):
    """The table so many times, person ids moved apart."""
    if COPIES == 1 or "person_id" not in table.columns:
        return table
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    return table.withColumn("_copy", copies).withColumn("person_id", F.col("person_id") + F.col("_copy") * 10_000_000).drop("_copy")


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    s = Stages(spark, folder)
    # The mapped clinical tables stand for tables that exist on disk, so mapping is not timed.
    s.tables = {name: materialize(copied(table)) for name, table in tm.tables(spark, folder).items()}
    config = tm.CONFIG
    analysis = None

    def extraction():
        cohort = pipeline.extract_cohort(s.tables, s.rules, config, store=False)
        consume(cohort.events)
        consume(cohort.timing)

    def study_analysis():
        nonlocal analysis
        analysis = materialize(study_queries.build_analysis(spark, folder))

    timed: dict[str, Callable[[], None]] = {
        "extraction": extraction,
        "outcome_episodes": lambda: consume(pipeline.outcome_stage(s.cohort, s.rules, config)),
        "progression_episodes": lambda: consume(pipeline.progression_stage(s.cohort, s.rules, config)),
        "merge": lambda: consume(pipeline.merge_stage(s.hip, s.pps, s.cohort, config)),
        "dating": lambda: consume(pipeline.dating_stage(s.merged, s.cohort, s.rules, config)),
        "pipeline": lambda: consume(pipeline.identify_episodes(s.tables, s.rules, config)),
        "concept_set_windows": lambda: consume(
            study.set_summary(
                study_queries.buffered(spark, folder), study_queries.events(spark, folder, "hf"),
                "inferred_episode_end", "observation_period_end_date", "hf",
            )
        ),
        "study_analysis": study_analysis,
        "kaplan_meier": lambda: consume(
            stats.kaplan_meier(analysis, "time_to_any_days_4y", "any_event_4y", "hdp_indicator")
        ),
        "cox": lambda: consume(
            regression.cox_ph(analysis, "time_to_any_days_4y", "any_event_4y", ["hdp_indicator", "mom_age"])
        ),
    }
    seconds: dict[str, float] = {}
    for name, run in timed.items():
        if ONLY and name not in ONLY:
            continue
        run()
        spent = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            spent.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(spent), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        **({"copies": COPIES} if COPIES > 1 else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
