"""Language ID by nearest centroids of TF-IDF n-gram vectors.

A text becomes its letters: A-Z in lower case, other ASCII characters as one space, bytes above 0x7F as they are.  Its 2-
and 3-byte n-grams are hashed into `DIMS` counters, weighted log(1 + tf) * idf and normalised.  Document frequencies are
counted over all documents learned from.  Each language has up to `centroids` unit centroids from spherical k-means over a
sample of its documents (`sample` documents a language at most, the first ones of a seeded order: a documented bound of
the fit).  A document gets the language of the centroid with the highest cosine.  It is rejected when that cosine is below
`reject` times the lowest cosine that counts as usual (the 1 % quantile) in the centroid's own sample; for a text of g
n-grams that bound shrinks by sqrt(g / (g + 100)), as a short text cannot come near any centroid.

Defined results: a null text, an empty one and one without a letter have language 'und', score 0 and are rejected.  Without
any document to learn from, all are 'und'.  Rows are judged one by one, so repeated rows get equal answers; ties go to the
first centroid by language name.  Input columns pass through; columns of the same names as the added ones are replaced.

Scale: two passes over texts, no shuffle of texts.  Between them travel one counter per task and dimension, and the sampled
vectors grouped by language.  The driver holds the model: DIMS counts and centroids * languages vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_episodes.llm.buffers import rows_of, slices, utf8
from care_episodes.llm.columns import held_out, packed, seeded_order, unpacked
from care_episodes.session import materialize

DIMS = 4096
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def has_letter(text):
    """A letter of any script."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def gram_counts(column: pa.Array) -> np.ndarray:
    """(rows, DIMS) counts of hashed 2- and 3-grams."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    # A space on both sides of every row, then runs of spaces become one.
    size = len(data) + 2 * n
    rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets) + 2)
    text = np.full(size, 32, np.uint8)
    if len(data):
        text[np.arange(len(data)) + 2 * rows_of(offsets) + 1] = _FOLD[data]
    keep = np.ones(size, bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32) | (rows[1:] != rows[:-1])
    text, rows = text[keep].astype(np.uint32), rows[keep]
    two = (text[:-1] << 8) | text[1:]
    three = (two[:-1] << 8) | text[2:]
    place = []
    for grams, width in ((two, 2), (three, 3)):
        same = rows[: len(grams)] == rows[width - 1 :]
        code = (((grams + np.uint32(width << 24)) * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
        place.append((rows[: len(grams)].astype(np.int64) * DIMS + code)[same])
    return np.bincount(np.concatenate(place), minlength=n * DIMS).reshape(n, DIMS)


def unit(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts.astype(np.float32)) * idf)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(DIMS, np.int64)
    for batch in slices(batches, "text"):
        total += (gram_counts(batch.column(0)) > 0).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS)), pa.array(total)], names=["gram", "n"])


def _sample_vectors(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = vectors(gram_counts(batch.column(0)), idf).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([v.tobytes() for v in found], pa.binary())], names=["lang", "place", "vector"]
            )

    return run


def _cluster(centroids: int, rounds: int = 12):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "vector"])
        points = unit(np.stack([np.frombuffer(v, np.float16) for v in rows["vector"]]).astype(np.float32))
        centers = points[:1]
        while len(centers) < min(centroids, len(points)):  # the point farthest from all centers so far
            near = (points @ centers.T).max(axis=1)
            if near.min() > 0.999:
                break
            centers = np.vstack([centers, points[near.argmin()]])
        for _ in range(rounds):
            own = (points @ centers.T).argmax(axis=1)
            centers = unit(np.stack([points[own == k].sum(axis=0) if (own == k).any() else centers[k] for k in range(len(centers))]))
        close = points @ centers.T
        own = close.argmax(axis=1)
        usual = [float(np.quantile(close[own == k, k], 0.01)) if (own == k).any() else 0.0 for k in range(len(centers))]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "k": range(len(centers)), "center": [c.tolist() for c in centers], "usual": usual})

    return run


def learn(examples: DataFrame, centroids: int = 4, sample: int = 300) -> dict:
    """The model from (text, lang, doc_id): idf over all examples, centroids per language from the sample."""
    examples = examples.where(has_letter(F.col("text")) & F.col("lang").isNotNull()).select(
        "text", "lang", seeded_order(F.col("doc_id"), 10).alias("place")
    )
    counts = (
        examples.select("text").mapInArrow(_frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    )  # DIMS rows
    seen = np.zeros(DIMS)
    for gram, n in counts:
        seen[gram] = n
    per_lang = materialize(examples.groupBy("lang").agg(F.count("*").alias("n")))
    total = per_lang.agg(F.sum("n")).first()[0] or 0
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)
    # A threshold on the seeded order keeps about twice the sample; the window that cuts it off sees no more than that.
    share = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("n"))
    few = (
        examples.join(per_lang.withColumnRenamed("lang", "l"), F.col("lang") == F.col("l"))
        .where(F.col("place") < share * float(1 << 60))
        .select("text", "lang", "place")
    )
    found = few.mapInArrow(_sample_vectors(idf), "lang string, place long, vector binary")
    first = F.expr("row_number() over (partition by lang order by place, vector)")
    rows = (
        found.withColumn("rank", first)
        .where(F.col("rank") <= sample)
        .drop("rank")
        .groupBy("lang")
        .applyInPandas(_cluster(centroids), "lang string, k int, center array<float>, usual double")
        .orderBy("lang", "k")
        .collect()
    )
    return {
        "idf": idf,
        "langs": [r.lang for r in rows],
        "centers": np.array([r.center for r in rows], np.float32).reshape(len(rows), DIMS),
        "usual": np.array([r.usual for r in rows], np.float32),
    }


def _predict(model: dict, reject: float):
    names = np.array(model["langs"] + [UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = batch.num_rows
            known = np.asarray(batch.column(batch.schema.get_field_index("lettered")).to_numpy(zero_copy_only=False), bool)
            best, score, length = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n)
            if len(names) > 1 and known.any():
                text = batch.column(batch.schema.get_field_index("text"))
                counts = gram_counts(text)
                length = counts.sum(axis=1)
                close = vectors(counts, model["idf"]) @ model["centers"].T
                best = np.where(known, close.argmax(axis=1), best)
                score = np.where(known, np.clip(close.max(axis=1), 0, 1), 0.0)
            bound = np.append(model["usual"], np.inf)[best] * np.sqrt(length / (length + 100))
            bound[~known] = np.inf
            rest = [batch.column(i) for i, f in enumerate(batch.schema) if f.name not in ("text", "lettered")]
            kept = [f.name for f in batch.schema if f.name not in ("text", "lettered")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(names[best], pa.string()), pa.array(score.astype(float)), pa.array(~(score >= reject * bound))],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    return run


def identify(docs: DataFrame, model: dict, reject: float = 0.35) -> DataFrame:
    """The documents with lang_pred, score and rejected."""
    rows = packed(docs, text=F.col("text"), lettered=has_letter(F.col("text")))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return unpacked(rows.mapInArrow(_predict(model, reject), schema), "lang_pred", "score", "rejected")


def learned_rows(docs: DataFrame) -> DataFrame:
    """The documents learned from: a known language, and not held out."""
    return docs.where(~held_out(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull()).select("text", "lang", "doc_id")


def language_digest(docs: DataFrame, reject: float = 0.35) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; only the id travels with the text."""
    model = learn(learned_rows(docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text", has_letter(F.col("text")).alias("lettered"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_predict(model, reject), f"doc_id {id_type}, held_out boolean, lang_pred string, score double, rejected boolean")
