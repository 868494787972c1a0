"""From raw documents to a training mix: language ID, line dedup, near-dedup, decontamination, mixing.

Each stage gets all rows its predecessor kept and returns the columns of `documents`; the last one adds size, source_size, target,
n_repeats, taken and epoch.

Defined results: documents with null or letterless text go in the first stage.  Documents that lose all lines with words go in the second;
one line that stands earlier, in whatever document, is enough to lose that line.  Rows that repeat doc_id and text stay or go together;
different texts with one doc_id, or with none, are documents of their own.  A null source is a source of its own.  Further input columns
pass through all stages; an input column named like an added one (`epoch`, `size`, ...) passes the first four stages and is replaced
in the last.  An empty table gives an empty mix.  Line dedup comes before near-dedup and takes most copies away line by line, so
near-dedup sees what is left of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_episodes.llm import contamination, language, line_dedup, lsh_forest, mixing
from care_episodes.session import shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that have no letters or are far from every language learned from the labelled ones."""
    judged = language.identify(docs, language.learn(language.learned_rows(docs)))
    return judged.where(~F.col("rejected")).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that stand earlier, or nearly so; documents left without a word go."""
    return line_dedup.clean(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of each group of near copies."""
    return lsh_forest.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, edited or not."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time a document is taken, numbered by `epoch`, with the sizes and targets of its source."""
    return mixing.repeat_rows(mixing.mix(docs))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
]

#: Alignment and learned centroids can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
