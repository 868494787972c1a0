"""Benchmark decontamination: n-gram seeds find candidates, Smith-Waterman alignment scores them.

Words: the text in lower case; runs of letters a-z, digits and anything beyond ASCII.  First pass: in how many documents each
`SEED_WORDS`-gram of the benchmark occurs, counted over all documents.  An item's seeds are all its grams that occur in some
document, however often, so that any copy with `SEED_WORDS` words left in a row holds a seed.  Second pass: a hit is a place in a
document, an item and the diagonals from the item's first to its last place of that gram, so a gram that an item repeats is one hit.  Hits
of one item on near diagonals of a document form a window, and the item is aligned with each window by words (match 1, mismatch and
gap -0.6).  The score is the best local alignment divided by the item's length.  A pair counts when it reaches `least`; items
under `SHORT` words must be there in full, those of one or two words are looked up as they are.

Defined results: null and empty texts, and texts and items without words, pair with nothing.  Rows that repeat a doc_id are judged one by one; equal rows of the result are listed once.  Benchmark rows that
repeat an item_id are separate texts, the best score counts.  Ties do not matter, as scores and not places are returned.

Scale: the benchmark is a set of queries that is held in blocks of at most `BLOCK_WORDS` words, each block compared with all
documents by two scans without a shuffle of texts.  What reaches the driver is a block and one count for each of its grams.  A gram
of many items doesn't make a large table of hits: rows, and where one row is too much items, are taken `HITS` hits at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from care_episodes.llm.buffers import slices, utf8
from care_episodes.llm.columns import packed, unpacked
from care_episodes.llm.words import LETTERS, LOWER, windows, word_hashes
from care_episodes.session import materialize

SEED_WORDS = 3
#: Scores are counted in tenths, so that they are exact.
MATCH, PENALTY = 10, 6
LEAST = 0.5
SHORT = 8
BLOCK_WORDS = 400_000
#: Pairs aligned at once, and cells of a row of the alignment.
BATCH, CELLS = 256, 1 << 21
#: Hits held at a time.
HITS = 1 << 20


def text_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, bounds): row i has the words bounds[i]..bounds[i + 1] - 1."""
    data, offsets = utf8(column)
    hashes, _, _, row = word_hashes(LOWER[data], offsets, LETTERS)
    return hashes, np.searchsorted(row, np.arange(len(offsets)))


def grams(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of SEED_WORDS words within a row."""
    runs = windows(hashes, SEED_WORDS)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(row[: len(runs)] == row[SEED_WORDS - 1 :]) if len(runs) else np.zeros(0, np.int64)
    return runs[at], at


class Lookup:
    """Finds hashes in a sorted set; a bit table turns most misses away."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.table = np.zeros(1 << 20, bool)
        self.table[(values >> np.uint64(44)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into hashes, index into values) of the hits."""
        maybe = np.flatnonzero(self.table[(hashes >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        good = self.values[k] == hashes[maybe]
        return maybe[good], k[good]


def _frequencies(values: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = Lookup(values), np.zeros(len(values), np.int64)
        for batch in slices(batches, "text"):
            hashes, bounds = text_words(batch.column(0))
            found, at = grams(hashes, bounds)
            hit, k = find(found)
            row = np.searchsorted(bounds, at[hit], side="right") - 1
            pairs = np.unique(row * len(values) + k)
            total += np.bincount(pairs % len(values), minlength=len(values))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    return run


def smith_waterman(items: list[np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its text."""
    best = np.zeros(len(items), np.int64)
    order = np.argsort([len(t) for t in texts], kind="stable")
    start = 0
    while start < len(order):
        size = BATCH
        while size > 1 and size * len(texts[order[min(start + size, len(order)) - 1]]) > CELLS:
            size //= 2
        part = order[start : start + size]
        start += size
        wide, high = max(len(texts[i]) for i in part), max(len(items[i]) for i in part)
        text = np.zeros((len(part), wide), np.uint64)
        item = np.ones((len(part), high), np.uint64)
        inside = np.zeros((len(part), wide), bool)
        lasts = np.array([len(items[i]) for i in part])
        for r, i in enumerate(part):
            text[r, : len(texts[i])] = texts[i]
            inside[r, : len(texts[i])] = True
            item[r, : len(items[i])] = items[i]
        slope = PENALTY * np.arange(wide, dtype=np.int32)
        above = np.zeros((len(part), wide + 1), np.int32)
        top = np.zeros(len(part), np.int32)
        for k in range(high):
            same = (text == item[:, k : k + 1]) & inside
            score = above[:, :-1] + np.where(same, np.int32(MATCH), np.int32(-PENALTY))
            np.maximum(score, above[:, 1:] - np.int32(PENALTY), out=score)
            np.maximum(score, 0, out=score)
            above[:, 1:] = np.maximum.accumulate(score + slope, axis=1) - slope  # a gap in the item
            np.maximum(top, np.where(k < lasts, above.max(axis=1), 0), out=top)
        best[part] = top
    return best / MATCH


class Seeds:
    """The items' grams: for each distinct one the items that hold it, with their first and last place of it."""

    def __init__(self, found: np.ndarray, item: np.ndarray, place: np.ndarray):
        order = np.lexsort((place, item, found))
        found, item, place = found[order], item[order], place[order]
        fresh = np.append(True, (found[1:] != found[:-1]) | (item[1:] != item[:-1]))
        start = np.flatnonzero(fresh)
        self.item, self.first, self.last = item[start], place[start], place[np.append(start[1:], len(found)) - 1]
        self.values, of = np.unique(found[start], return_inverse=True)
        self.n_items = int(self.item.max()) + 1
        self.owner = of * self.n_items + self.item  # ascending

    def range(self, k: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the owners of the values k among items low..high - 1 begin, and how many they are."""
        a = np.searchsorted(self.owner, k * self.n_items + low)
        return a, np.searchsorted(self.owner, k * self.n_items + high) - a


def hits(seeds: Seeds, k: np.ndarray, row: np.ndarray, where: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, item, first and last diagonal) of the places `where` (in their rows) that hold the values k; some rows, or some items, at a time."""
    _, times = seeds.range(k, 0, seeds.n_items)
    start = 0
    while start < len(k):
        total = np.cumsum(times[start:])
        end = start + int(np.searchsorted(total, HITS, side="right"))
        if end < len(k):
            end = max(start, int(np.searchsorted(row, row[min(end, len(k) - 1)])))  # whole rows
        parts = 1
        if end == start:  # one row alone has more
            end = int(np.searchsorted(row, row[start], side="right"))
            parts = min(seeds.n_items, -(-int(total[end - start - 1]) // HITS))
        some = slice(start, end)
        for p in range(parts):
            low, high = seeds.n_items * p // parts, seeds.n_items * (p + 1) // parts
            at, n = seeds.range(k[some], low, high)
            spot = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(where[some], n)
            yield np.repeat(row[some], n), seeds.item[spot], place - seeds.last[spot], place - seeds.first[spot]
        start = end


def _aligned(seeds: Seeds | None, brief: dict[int, tuple[np.ndarray, np.ndarray]], words: np.ndarray, bounds: np.ndarray, ids: list, id_type: pa.DataType, least: float) -> Callable:
    """`brief` has the sequences of items of one and two words by their length: (hashes, items), by hash."""
    length = np.diff(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(seeds.values) if seeds else None
        for batch in slices(batches, "text", most_rows=1000):
            hashes, rows = text_words(batch.column(2))
            best: dict[tuple[int, int], float] = {}
            for n, (values, items) in brief.items():
                runs = windows(hashes, n)
                own = np.searchsorted(rows, np.arange(len(runs)), side="right") - 1
                whole = np.flatnonzero(np.arange(len(runs)) + n <= rows[own + 1]) if len(runs) else np.zeros(0, np.int64)
                low, high = np.searchsorted(values, runs[whole]), np.searchsorted(values, runs[whole], side="right")
                for w in np.flatnonzero(high > low):
                    for y in items[low[w] : high[w]]:
                        best[int(own[whole[w]]), int(y)] = 1.0
            if find:
                found, at = grams(hashes, rows)
                hit, k = find(found)
                own = np.searchsorted(rows, at[hit], side="right") - 1
                for row, item, low, high in hits(seeds, k, own, at[hit] - rows[own]):
                    _align(best, hashes, rows, words, bounds, length, least, row, item, low, high)
            if best:
                keys = list(best)
                take = pa.array([x for x, _ in keys])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array([ids[y] for _, y in keys], id_type), pa.array([best[x] for x in keys])],
                    names=["doc_id", "text_id", "item_id", "score"],
                )

    return run


def _align(best, hashes, rows, words, bounds, length, least, row, item, first, last) -> None:
    """Joins hits on near diagonals to windows, aligns them, and keeps the best score of each (row, item) that reaches the threshold."""
    if not len(row):
        return
    order = np.lexsort((first, item, row))
    row, item, first, last = row[order], item[order], first[order], last[order]
    slack = np.maximum(4, length[item] // 4)
    pair = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]))
    # The furthest diagonal so far within the pair.
    base = np.cumsum(pair) * (1 << 40)
    reach = np.maximum.accumulate(last + base) - base
    fresh = pair.copy()
    fresh[1:] |= first[1:] - reach[:-1] > slack[1:]
    start = np.flatnonzero(fresh)
    end = np.append(start[1:], len(row)) - 1
    r, i = row[start], item[start]
    low = np.maximum(first[start] - slack[start], 0) + rows[r]
    high = np.minimum(reach[end] + length[i] + slack[start] + rows[r], rows[r + 1])
    for a in range(0, len(r), 4 * BATCH):
        part = slice(a, a + 4 * BATCH)
        scores = smith_waterman(
            [words[bounds[x] : bounds[x + 1]] for x in i[part]], [hashes[x:y] for x, y in zip(low[part], high[part], strict=True)]
        )
        for x, y, s in zip(r[part], i[part], scores / length[i[part]], strict=True):
            if s >= (least if length[y] >= SHORT else 1.0) - 1e-6:
                best[int(x), int(y)] = max(best.get((int(x), int(y)), 0.0), float(s))


def blocks(benchmark: DataFrame) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of bounded size: (item ids, texts)."""
    sized = benchmark.select("item_id", F.lower("text").alias("text")).where("text is not null")
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // (3 * BLOCK_WORDS)  # a word and its gap have three characters at least, as a rule
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        rows = sized.where(block == k).orderBy("item_id", "text").collect()
        yield [r.item_id for r in rows], [r.text for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, text_id, item_id, score) of every document and item that align; text_id is a hash of the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_kind = "string" if isinstance(benchmark.schema["item_id"].dataType, StringType) else "long"
    schema = f"doc_id {kind}, text_id long, item_id {id_kind}, score double"
    out = docs.sparkSession.createDataFrame([], schema)
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_id"), F.lower("text").alias("text"))
    for ids, texts in blocks(benchmark.withColumn("item_id", F.col("item_id").cast(id_kind))):
        words, bounds = text_words(pa.array(texts, pa.string()))
        brief = {}
        for n in range(1, SEED_WORDS):
            items = np.flatnonzero(np.diff(bounds) == n)
            if len(items):
                runs = windows(words, n)[bounds[items]]
                order = np.argsort(runs, kind="stable")
                brief[n] = (runs[order], items[order])
        found, at = grams(words, bounds)
        seeds = None
        if len(found):
            values, which = np.unique(found, return_inverse=True)
            counts = rows.select("text").mapInArrow(_frequencies(values), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
            frequency = np.zeros(len(values), np.int64)
            for gram, n in counts:  # one row for each gram of the block
                frequency[gram] = n
            used = np.flatnonzero(frequency[which])
            if len(used):
                item = np.searchsorted(bounds, at[used], side="right") - 1
                seeds = Seeds(found[used], item, at[used] - bounds[item])
        if seeds or brief:
            out = out.union(rows.mapInArrow(_aligned(seeds, brief, words, bounds, ids, pa.string() if id_kind == "string" else pa.int64(), least), schema))
    best = out.groupBy("doc_id", "text_id", "item_id").agg(F.max("score").alias("score"))
    return materialize(best)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score) of every contaminated document."""
    return contaminated(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that align with no item."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("text_id").alias("leak_text")).distinct()
    rows = packed(docs, id=F.col("doc_id"), text_id=F.xxhash64("text"))
    return unpacked(rows.join(found, F.col("id").eqNullSafe(F.col("leak_id")) & (F.col("text_id") == F.col("leak_text")), "left_anti"))
