"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

DataFrame operations only.  Sources sorted by code point (null last) get the weights 5, 2, 1, 5, 2, 1, ...  Together
they share `share` times all words; no source gets more than `max_epochs` times its own words.  A source that reaches
that limit is clamped, what it cannot take is shared again by weight among the others, until none is above its limit.
With target = (whole + fraction) * source size each document is repeated `whole` times, and the documents that come first
in a seeded order are repeated once more until the fraction is filled to the nearest document.

Defined results: null or empty text has size 0 and takes 0 words; a null source is a source of its own and the last one;
rows that repeat doc_id and text stand at one place of the order and are taken together; an empty table gives an empty result; all
sizes 0 give targets 0.  Input columns named like an added column are replaced by it, others pass through.

Scale: texts are read once for sizes and once for the output.  All else works on (source, size, order) rows, summed on the
map side into 65,536 buckets of the order per source, so that a hot source is spread out.  The cut is sought in 256 pieces of
256 buckets, then in the buckets of one piece; only the one bucket that holds it is ordered row by row.  A filling round sums one row from the table of sources; two numbers reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.llm.columns import packed, seeded_order, unpacked, word_count
from care_episodes.session import materialize

WEIGHTS = (5, 2, 1)
ORDER_BITS, BUCKET_BITS, COARSE_TO_FINE = 60, 16, (8, 16)
IN_BUCKET = 1 << (ORDER_BITS - BUCKET_BITS)


def ranked(df: DataFrame, by: str, rank: str) -> DataFrame:
    """Numbers the rows from 0 by `by` (null last): sorted over all tasks, counted per task, shifted by the counts before."""
    piece = materialize(df.orderBy(F.col(by).asc_nulls_last()).withColumn("piece", F.spark_partition_id()))
    before = piece.groupBy("piece").count().select(
        "piece", (F.sum("count").over(Window.orderBy("piece")) - F.col("count")).alias("before")
    )  # a row per task of the sort
    inside = F.row_number().over(Window.partitionBy("piece").orderBy(F.col(by).asc_nulls_last()))
    return piece.withColumn("inside", inside).join(before, "piece").withColumn(
        rank, F.col("before") + F.col("inside") - 1
    ).drop("piece", "before", "inside")


def fill(sources: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """Adds `target` to (source, source_size, weight)."""
    cap = F.col("source_size") * max_epochs
    full = F.lit(False)
    known = None
    while True:
        row = sources.select(
            F.sum("source_size").alias("size"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("clamped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        rest = min(share, max_epochs) * (row.size or 0) - row.clamped
        if (row.clamped, row.weights) == known or not row.weights:
            break
        known = (row.clamped, row.weights)
        level = rest / row.weights
        full = cap.cast("double") <= F.col("weight") * F.lit(level)
    open_target = F.col("weight") * F.lit(rest / row.weights if row.weights else 0.0)
    return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(open_target))


def source_plan(
    sized: DataFrame, share: float = 1.5, max_epochs: int = 2, weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """(source, source_size, target, whole, last): `last` is the last place of the order that is taken once more, or -1."""
    bucket = F.expr(f"shiftright(place, {ORDER_BITS - BUCKET_BITS})")
    counts = materialize(
        sized.withColumn("bucket", bucket).groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    )
    sizes = ranked(counts.groupBy("source").agg(F.sum("words").alias("source_size")), "source", "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    plan = fill(materialize(sizes.select("source", "source_size", weight.cast("long").alias("weight"))), share, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(ratio), F.lit(max_epochs)).cast("long")
    plan = materialize(
        plan.withColumn("whole", whole)
        .withColumn("wanted", F.when(whole < max_epochs, F.col("target") - whole * F.col("source_size")).otherwise(F.lit(0.0)))
    )
    cut = materialize(
        plan.where("wanted > 0").select(F.col("source").alias("cut_source"), F.lit(0).cast("long").alias("cut_bucket"), F.lit(0).cast("long").alias("base"), "wanted")
    )
    for bits in COARSE_TO_FINE:  # the piece of the order that holds the cut, then the piece of that piece
        part = F.expr(f"shiftright(bucket, {BUCKET_BITS - bits})")
        whole_piece = F.expr(f"shiftright(bucket, {BUCKET_BITS - bits + 8})")
        pieces = (
            counts.join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & (whole_piece == F.col("cut_bucket")))
            .groupBy("cut_source", part.alias("part"), "base", "wanted").agg(F.sum("words").alias("words"))
        )  # 256 rows for each source at most
        upto = F.col("base") + F.sum("words").over(Window.partitionBy("cut_source").orderBy("part"))
        cut = materialize(
            pieces.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("words") < F.col("wanted")))
            .select("cut_source", F.col("part").alias("cut_bucket"), (F.col("upto") - F.col("words")).alias("base"), "wanted")
        )
    inside = (
        sized.withColumn("bucket", bucket)
        .join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("bucket") == F.col("cut_bucket")))
        .groupBy("cut_source", "cut_bucket", "place", "base", "wanted").agg(F.sum("size").alias("words"))
    )
    so_far = F.col("base") + F.sum("words").over(Window.partitionBy("cut_source", "cut_bucket").orderBy("place"))
    last = (
        inside.withColumn("middle", so_far - F.col("words") / 2)
        .groupBy("cut_source", "cut_bucket")
        .agg(F.max(F.when(F.col("middle") <= F.col("wanted"), F.col("place"))).alias("last"))
        .select("cut_source", F.coalesce("last", F.col("cut_bucket") * IN_BUCKET - 1).alias("last"))
    )
    return materialize(
        plan.join(last, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
            "source", "source_size", "target", "whole", F.coalesce("last", F.lit(-1)).alias("last")
        )
    )


def repeats() -> Column:
    return F.col("whole") + F.when(F.col("place") <= F.col("last"), 1).otherwise(0)


def place_of(seed: int) -> Column:
    """A document's place in the order: by its id and text."""
    return seeded_order(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))), seed)


def mix(docs: DataFrame, seed: int = 17, share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """Each document with size, source_size, target, n_repeats and taken (size * n_repeats)."""
    place = place_of(seed)
    sized = materialize(docs.select("source", word_count(F.col("text")).alias("size"), place.alias("place")))
    plan = source_plan(sized, share, max_epochs).withColumnRenamed("source", "plan_source")
    rows = packed(docs, of=F.col("source"), size=word_count(F.col("text")), place=place)
    out = (
        rows.join(plan, F.col("of").eqNullSafe(F.col("plan_source")))
        .withColumn("n_repeats", repeats())
        .withColumn("taken", F.col("size") * F.col("n_repeats"))
    )
    return unpacked(out, "size", "source_size", "target", "n_repeats", "taken")


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is repeated, numbered by `epoch` from 1."""
    rows = packed(mixed, n=F.col("n_repeats")).where("n > 0")
    return unpacked(rows.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("epoch")), "epoch")


def mix_digest(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document; works on sizes, texts are read once."""
    place = place_of(seed)
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), place.alias("place")))
    plan = source_plan(sized).withColumnRenamed("source", "plan_source")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats()).alias("taken")
    )


#: Sources get their level by trying every number of clamped sources in order of limit to weight.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS place FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight FROM sized GROUP BY source),
steps AS (
  SELECT *, sum(2 * source_size) OVER w AS caps, sum(weight) OVER w AS used, sum(source_size) OVER () AS total,
         sum(weight) OVER () AS weights FROM sources WINDOW w AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)),
cuts AS (
  SELECT caps - 2 * source_size AS clamped, weights - used + weight AS open FROM steps
  WHERE 2.0 * source_size / weight > (1.5 * total - (caps - 2 * source_size)) / (weights - used + weight)
  ORDER BY caps, used LIMIT 1),
targets AS (
  SELECT s.source, s.source_size, s.weight, least(2.0 * s.source_size,
         s.weight * ((1.5 * s.total - coalesce((SELECT clamped FROM cuts), 2 * s.total))::DOUBLE
                     / coalesce((SELECT open FROM cuts), 1)))::DOUBLE AS level,
         (SELECT count(*) FROM cuts) AS has_cut FROM steps s),
plan AS (
  SELECT source, source_size, CASE WHEN has_cut = 0 THEN 2.0 * source_size ELSE level END::DOUBLE AS target FROM targets),
reps AS (
  SELECT *, least(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END), 2)::BIGINT AS whole FROM plan),
placed AS (
  SELECT s.*, r.source_size, r.target, r.whole,
         CASE WHEN r.whole < 2 THEN r.target - r.whole * r.source_size ELSE 0 END AS wanted,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place RANGE UNBOUNDED PRECEDING) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.place) AS own
  FROM sized s JOIN reps r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN wanted > 0 AND upto - own / 2.0 <= wanted THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed
"""
