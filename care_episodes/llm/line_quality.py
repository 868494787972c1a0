r"""Document quality from a linear-chain conditional random field over lines.

Lines are split at \n.  Each line has features of its bytes and words (lengths, upper case, symbols, digits, repeated words ...)
and those of the line before and after it.  A two-state chain labels every line good or bad; forward-backward gives each
line's chance to be good, and the mean of these weighted by line length is the document's quality.  A logistic curve fitted to
the sample turns it into a score, so that 0.5 separates the classes.

The fit uses labelled documents outside the held-out fold only: the first `SAMPLE` of each class in a seeded order, and of those
the ones of at most `SAMPLE_LINES` lines (documented bounds of the fit).  Every line of a document takes its label; weights come
from gradient ascent on the conditional likelihood.  Labels, language, source and doc_id are never inputs of a score.

Defined results: null and empty texts are one empty line and get that line's score.  Each row is scored by itself, so repeated
rows get equal scores.  A doc_id with two different labels is not learned from, null labels neither.  Without labels all scores
are 0.5, with one class only all have the score of that class, 0 or 1.  Extra columns pass through.

Scale: texts are read twice (once for the sample) and not shuffled; the sample's ids are a table of 2 * SAMPLE rows and so
bounded.  The model is one vector.  Memory is bounded by a slice of texts, or a single longer text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_episodes.llm.buffers import slices, sums, utf8
from care_episodes.llm.columns import held_out, packed, seeded_order, unpacked
from care_episodes.llm.words import LOWER, NOT_SPACE, word_hashes

SAMPLE, SAMPLE_LINES = 1500, 500
STEPS, RATE, RIDGE = 150, 0.15, 1e-3


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b] = True
    return table


UPPER, LETTER, DIGIT, HIGH = _table((65, 91)), _table((65, 91), (97, 123), (128, 256)), _table((48, 58)), _table((128, 256))
SENTENCE = np.zeros(256, bool)
SENTENCE[[ord(c) for c in ".,;:'\"!?()-"]] = True
ODD = ~(LETTER | DIGIT | SENTENCE | _table((0, 33)))
FEATURES = 13


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, bounds) of the lines of each row: lines bounds[i]..bounds[i + 1] - 1 belong to row i."""
    data, offsets = utf8(column)
    breaks = np.flatnonzero(data == 10)
    rows = len(offsets) - 1
    row_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    row = np.sort(np.concatenate([np.arange(rows), row_of_break]), kind="stable")
    edges = np.append(starts, len(data))
    bounds = np.append(np.searchsorted(row, np.arange(rows)), len(row))

    def share(table: np.ndarray) -> np.ndarray:
        return sums(table[data], edges)

    size = np.diff(edges).astype(float)
    hashes, first, last, _ = word_hashes(LOWER[data], np.unique(edges), NOT_SPACE)
    line = np.searchsorted(starts, first, side="right") - 1
    words = np.bincount(line, minlength=len(starts)).astype(float)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(line[mask], minlength=len(starts)) / np.maximum(words, 1)

    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    odd_end = ODD[data[last - 1]] if len(last) else np.zeros(0, bool)
    loud = (data[last - 1] == 33) & (last - first > 1) & (data[np.maximum(last - 2, 0)] == 33) if len(last) else np.zeros(0, bool)
    letters = np.maximum(share(LETTER), 1)
    begin = np.minimum(starts, max(len(data) - 1, 0))
    end = np.maximum(edges[1:] - 1, 0)
    end = np.where((end > 0) & (end < len(data)) & (size > 0), end, 0)
    end = end - (data[end] == 10) * (end > starts) if len(data) else end
    filled = words > 0
    features = np.stack(
        [
            np.log1p(words) / 5, np.minimum(share(NOT_SPACE) / np.maximum(words, 1) / 10, 3), share(UPPER) / letters, share(ODD) / np.maximum(size, 1) * 4,
            share(DIGIT) / np.maximum(size, 1) * 4, np.minimum(share(SENTENCE) / np.maximum(words, 1), 2), of_words(same) * 2, of_words(odd_end),
            of_words(loud), of_words((last - first == 1) & odd_end), share(HIGH) / np.maximum(size, 1),
            (filled & (np.isin(data[end], [46, 33, 63]) if len(data) else False)).astype(float),
            (filled & (UPPER[data[begin]] if len(data) else False)).astype(float),
        ],
        axis=1,
    )
    return features, size, bounds


def with_neighbours(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after it in its document (zeros at the ends), and a constant."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[bounds[:-1][np.diff(bounds) > 0]] = 0
    after[bounds[1:][np.diff(bounds) > 0] - 1] = 0
    return np.concatenate([features, before, after, np.ones((len(features), 1))], axis=1)


def marginals(good: np.ndarray, chain: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all documents at once.

    good: score of state good over bad for every line; chain[i, j]: score of state i followed by j.
    Returns the chance that each line is good, expected transitions [i, j], and the log of each document's total weight.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    start, count = bounds[:-1][order], lengths[order]
    longest = int(count[0]) if len(count) else 0
    jump = np.exp(chain)
    shift = np.maximum(good, 0)
    weight = np.stack([np.exp(-shift), np.exp(good - shift)], axis=1)
    ahead, behind = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    scale = np.ones(len(good))
    active = np.searchsorted(-count, -np.arange(longest), side="left")  # documents that have a line number t
    for t in range(longest):
        at = start[: active[t]] + t
        value = weight[at] if t == 0 else (ahead[at - 1] @ jump) * weight[at]
        scale[at] = value.sum(axis=1)
        ahead[at] = value / scale[at, None]
    for t in range(longest - 1, -1, -1):
        n = active[t + 1] if t + 1 < longest else 0
        at = start[: active[t]] + t
        behind[at] = 1
        if n:
            nxt = at[:n] + 1
            behind[at[:n]] = (weight[nxt] * behind[nxt]) @ jump.T / scale[nxt, None]
    both = ahead * behind
    chance = both[:, 1] / np.maximum(both.sum(axis=1), 1e-300)
    inner = np.ones(len(good), bool)
    inner[bounds[:-1][lengths > 0]] = False
    nxt = np.flatnonzero(inner)
    pairs = ahead[nxt - 1][:, :, None] * jump[None] * (weight[nxt] * behind[nxt])[:, None, :] / scale[nxt][:, None, None]
    total = sums(np.log(scale) + shift, bounds)
    return chance, pairs.sum(axis=0) if len(nxt) else np.zeros((2, 2)), total


def quality(chance: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean chance of each document's lines, weighted by their length."""
    return sums(chance * (size + 1), bounds) / np.maximum(sums(size + 1, bounds), 1)


def fit(features: np.ndarray, size: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> dict:
    """Weights of the chain by gradient ascent (Adam), then the logistic curve of the document score."""
    inputs = with_neighbours(features, bounds)
    target = np.repeat(label, np.diff(bounds)).astype(float)
    inner = np.ones(len(target), bool)
    inner[bounds[:-1]] = False
    nxt = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (target[nxt - 1].astype(int), target[nxt].astype(int)), 1)
    theta = np.zeros(inputs.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        chance, pairs, _ = marginals(inputs @ theta[:-4], theta[-4:].reshape(2, 2), bounds)
        gradient = np.concatenate([(target - chance) @ inputs, (seen - pairs).ravel()]) / len(target) - RIDGE * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    chance, _, _ = marginals(inputs @ theta[:-4], theta[-4:].reshape(2, 2), bounds)
    x = np.stack([quality(chance, size, bounds), np.ones(len(label))], axis=1)
    curve = np.zeros(2)
    for _ in range(25):  # Newton steps with a small ridge, so that separable classes stay finite
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        curve += np.linalg.solve(hessian, x.T @ (label - p) - 0.05 * curve)
    return {"theta": theta, "curve": curve}


def score(column: pa.Array, model: dict) -> np.ndarray:
    features, size, bounds = line_features(column)
    theta = model["theta"]
    chance, _, _ = marginals(with_neighbours(features, bounds) @ theta[:-4], theta[-4:].reshape(2, 2), bounds)
    x = quality(chance, size, bounds) * model["curve"][0] + model["curve"][1]
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        features, size, bounds = line_features(batch.column(0))
        few = np.flatnonzero(np.diff(bounds) <= SAMPLE_LINES)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([features[bounds[i] : bounds[i + 1]].astype(np.float32).tobytes() for i in few], pa.binary()),
                pa.array([size[bounds[i] : bounds[i + 1]].astype(np.float32).tobytes() for i in few], pa.binary()),
                batch.column(1).take(pa.array(few)), batch.column(2).take(pa.array(few)),
            ],
            names=["features", "size", "label", "place"],
        )


def learn(docs: DataFrame, labels: DataFrame) -> dict | float:
    """The model, or a constant score where there is nothing to tell apart."""
    known = (
        labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other and label in (0, 1)")
    )
    place = seeded_order(F.col("doc_id"), 3)
    ids = [known.where(F.col("label") == k).withColumn("place", place).orderBy("place", "doc_id").limit(SAMPLE) for k in (0, 1)]
    ids = F.broadcast(ids[0].union(ids[1]).select(F.col("doc_id").alias("id"), F.col("label").cast("int").alias("label"), "place"))  # 2 * SAMPLE rows
    rows = (
        docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id")).select("text", "label", "place")
        .mapInArrow(_sample_features, "features binary, size binary, label int, place long").orderBy("place", "features").collect()
    )
    classes = {r.label for r in rows}
    if len(classes) < 2:
        return float(next(iter(classes))) if classes else 0.5
    features = [np.frombuffer(r.features, np.float32).reshape(-1, FEATURES) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([len(f) for f in features])])
    size = np.concatenate([np.frombuffer(r.size, np.float32) for r in rows]).astype(float)
    return fit(np.concatenate(features).astype(float), size, bounds, np.array([r.label for r in rows], float))


def _scored(model: dict | float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            k = batch.schema.get_field_index("text")
            found = np.full(batch.num_rows, model) if isinstance(model, float) else score(batch.column(k), model)
            kept = [i for i in range(batch.num_columns) if i != k]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=[*[batch.schema.names[i] for i in kept], "score", "predicted"],
            )

    return run


def rate(docs: DataFrame, model: dict | float) -> DataFrame:
    """The documents with score and predicted."""
    rows = packed(docs, text=F.col("text"))
    found = rows.mapInArrow(_scored(model), f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int")
    return unpacked(found, "score", "predicted")


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "text")
    return rows.mapInArrow(_scored(learn(docs, labels)), f"doc_id {kind}, held_out boolean, score double, predicted int")
