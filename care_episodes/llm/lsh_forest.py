"""MinHash near-dedup with an LSH forest.

Words are runs of anything but ASCII white space, A-Z in lower case; a document's set is its distinct 5-word shingles, or
its whole word sequence if that is shorter.  Two documents are linked when 100 * intersection >= 75 * union.

1. Documents with equal sets form a class (128-bit fingerprint of the set); one signature stands for the class.
2. Every class gets `TREES * DEPTH` minhashes.  A tree sorts the classes by its own `DEPTH` minhashes; two classes with a
   common prefix of `MIN_DEPTH` values are neighbours of some depth.  Classes that meet no other class at that depth in any
   tree cannot have a candidate and leave early.
3. A quick round joins most copies: the others are sorted in all trees at once over the cluster, each one is compared with
   the `NEAREST` classes before it in the order that share a prefix, and its likeliest pair is confirmed on the full sets.
4. The whole round: every class is compared with all classes that share a prefix of `MIN_DEPTH` values with it in some tree and
   are not of its component.  A region of more than `CELL` classes is cut into blocks, and each pair of blocks is a cell of its
   own, so a thick region is dealt out and costs the square of its classes in comparisons.
5. Within a cell a pair is dropped if the sizes of the sets rule it out, or if its estimate is 5 standard deviations below the
   threshold: first by the 160 minhashes, then together with a finer sketch of `FINE` one-bit minhashes, which only classes that
   share a region with another component have.  So what leaves a cell are pairs near the threshold, not those that share a common passage.
6. They are confirmed on the full sets, the best of each class and component first, then more of those that are still apart, until
   no unconfirmed candidate joins two components.  A confirmed link never joins two documents below the threshold.

A pair at the threshold shares a prefix of 2 in a tree with probability 0.56, so the 20 trees miss it with 6e-8, and an estimate drops it
with 3e-7; tests and README measure the recall against brute force.

Defined results: null and empty texts and texts without words have an empty set, n_shingles 0, and are linked with nothing:
component_id is their own doc_id.  Rows that repeat a doc_id are rows of their own; their component is named by the smallest
doc_id in it.  A null doc_id never names a component unless it has no other id.  An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.functions.primitives import join_growing
from care_episodes.llm.buffers import slices, utf8
from care_episodes.llm.columns import packed, unpacked
from care_episodes.llm.components import components
from care_episodes.llm.words import LOWER, NOT_SPACE, mixed, sequence_hash, windows, word_hashes
from care_episodes.session import materialize

WIDTH = 5
TREES, DEPTH, MIN_DEPTH = 20, 8, 2
HASHES = TREES * DEPTH
#: Classes before a class in the order that it is compared with, in the quick round.
NEAREST = 2
#: A pair at the threshold falls below this estimate with a chance of about 1 in 3 million (5 standard deviations).
SURE = 0.17
#: One-bit minhashes of the finer sketch, and how far a pair at the threshold may fall below it by both sketches together (5 deviations).
FINE, SURE_FINE = 4096, 0.05
#: Classes of a block of a region.
CELL = 1000
#: Sets of a block when pairs are confirmed, and pairs of two blocks at least where there are few.
BLOCK_SETS, CELL_PAIRS = 500, 200
#: Candidates of a class and a component that are confirmed first; then come all that are still apart.
FIRST = 4
#: Bits of the table that keeps texts from being shuffled whose class met no other; a fixed size, so it is full where classes are very many.
MARKS = 1 << 23

_RANDOM = np.random.default_rng(20_240_517)
_FACTORS = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_FINE_FACTORS = _RANDOM.integers(1, 1 << 63, FINE, dtype=np.uint64) | np.uint64(1)
_FINE_SHIFTS = _RANDOM.integers(0, 1 << 63, FINE, dtype=np.uint64)
#: Weight of the finer sketch: variances at 0.75 are 0.75 * 0.25 / HASHES, and 4 * 0.875 * 0.125 / FINE for one bit.
_FINE_WEIGHT = (0.1875 / HASHES) / (0.1875 / HASHES + 0.4375 / FINE)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    data, offsets = utf8(column)
    hashes, _, _, row = word_hashes(LOWER[data], offsets, NOT_SPACE)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    runs = windows(hashes, width)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            yield np.unique(runs[a : b - width + 1])
        elif b > a:
            yield np.array([sequence_hash(hashes[a:b], 5)], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def minhashes(shingles: list[np.ndarray]) -> np.ndarray:
    """(sets, HASHES) 32-bit minhashes; rows of empty sets are 0."""
    out = np.zeros((len(shingles), HASHES), np.uint32)
    full = [i for i, s in enumerate(shingles) if len(s)]
    if full:
        values = np.concatenate([shingles[i] for i in full])
        starts = np.concatenate([[0], np.cumsum([len(shingles[i]) for i in full])[:-1]])
        for k in range(HASHES):
            hashed = ((values ^ _SHIFTS[k]) * _FACTORS[k]) >> np.uint64(32)
            out[full, k] = np.minimum.reduceat(hashed.astype(np.uint32), starts)
    return out


def fine_sketches(shingles: list[np.ndarray]) -> np.ndarray:
    """(sets, FINE / 8) bytes: the lowest bit of each of FINE minhashes; sets are not empty."""
    values = np.concatenate(shingles)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in shingles])[:-1]])
    bits = np.empty((FINE, len(shingles)), bool)
    for k in range(FINE):
        hashed = (((values ^ _FINE_SHIFTS[k]) * _FINE_FACTORS[k]) >> np.uint64(32)).astype(np.uint32)
        bits[k] = np.minimum.reduceat(hashed, starts) & np.uint32(1)
    return np.packbits(bits.T, axis=1)


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            sets = [x.values.to_numpy().view(np.uint64) for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([b.tobytes() for b in fine_sketches(sets)], pa.binary())], names=["set_id", "fine"])


def _fingerprint(shingles: np.ndarray) -> bytes:
    if not len(shingles):
        return b""
    total = shingles.sum(dtype=np.uint64)
    other = mixed(shingles ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)
    return np.array([total, other], np.uint64).tobytes()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = list(shingle_sets(batch.column(2)))
        signed = minhashes(sets)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_fingerprint(s) for s in sets], pa.binary()),
                pa.array([m.tobytes() for m in signed], pa.binary()),
            ],
            names=["doc_id", "text_id", "n_shingles", "set_id", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = list(shingle_sets(batch.column(0)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_fingerprint(s) for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            names=["set_id", "shingles"],
        )


def prefixes_of(signatures: pa.Array) -> np.ndarray:
    """(classes, TREES) hashes of the prefix a neighbour must share."""
    raw = np.frombuffer(b"".join(signatures.to_pylist()), np.uint32).reshape(-1, TREES, DEPTH).astype(np.uint64)
    prefix = (raw[:, :, 0] << np.uint64(32)) | raw[:, :, 1]
    return mixed(prefix + np.arange(TREES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and tree: the prefix a neighbour must share."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            n = part.num_rows
            prefix = prefixes_of(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(np.repeat(np.arange(n), TREES))), pa.array(prefix.ravel())],
                names=["set_id", "prefix"],
            )


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and tree: sort key of the tree, and 8 bits of every minhash for the estimate."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            n = part.num_rows
            raw = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(n, HASHES)
            ordered = raw.astype(">u4")  # bytes that sort as the numbers do
            few = raw.astype(np.uint8)
            keys = [bytes([t]) + ordered[i, t * DEPTH : (t + 1) * DEPTH].tobytes() for i in range(n) for t in range(TREES)]
            sketch = [few[i].tobytes() for i in range(n) for _ in range(TREES)]
            take = pa.array(np.repeat(np.arange(n), TREES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), part.column(0).take(take), pa.array(sketch, pa.binary())],
                names=["place", "set_id", "sketch"],
            )


def likeliest(x: np.ndarray, y: np.ndarray, estimate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that are the best one of either class."""
    keep = np.zeros(len(x), bool)
    for own in (x, y):
        best = np.zeros(int(own.max()) + 1 if len(own) else 0)
        np.maximum.at(best, own, estimate)
        keep |= estimate >= best[own]
    return x[keep], y[keep], estimate[keep]


def _neighbours(threshold: float, nearest: int):
    prefix = 1 + 4 * MIN_DEPTH
    least = threshold - SURE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compares each row with those just before it that share MIN_DEPTH values; rows come in order."""
        tail: tuple[list, list, np.ndarray] = ([], [], np.zeros((0, HASHES), np.uint8))
        for batch in batches:
            for start in range(0, batch.num_rows, 5000):
                part = batch.slice(start, 5000)
                keys, names = tail[0] + [k[:prefix] for k in part.column(0).to_pylist()], tail[1] + part.column(1).to_pylist()
                few = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(-1, HASHES)
                few = np.concatenate([tail[2], few])
                fresh = len(tail[0])
                key = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, prefix)
                pairs = []
                for back in range(1, min(nearest, len(keys) - 1) + 1):
                    late = np.arange(max(back, fresh), len(keys))
                    late = late[(key[late] == key[late - back]).all(axis=1)]
                    if not len(late):
                        continue
                    share = (few[late] == few[late - back]).mean(axis=1)
                    estimate = (share - 1 / 256) / (1 - 1 / 256)
                    good = estimate >= least
                    pairs.append((late[good], late[good] - back, estimate[good]))
                tail = (keys[-nearest:], names[-nearest:], few[-nearest:])
                if pairs:
                    x, y, e = likeliest(*(np.concatenate(c) for c in zip(*pairs, strict=True)))
                    if len(x):
                        swap = [names[i] < names[j] for i, j in zip(x, y, strict=True)]
                        a, b = np.where(swap, y, x), np.where(swap, x, y)
                        yield pa.RecordBatch.from_arrays(
                            [*[pa.array([names[i] for i in c], pa.binary()) for c in (a, b)], pa.array(e)], names=["a", "b", "estimate"]
                        )

    return run


def _apart(threshold: float):
    least = threshold - SURE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All pairs within a cell that are of two components, in the first tree where they meet; rows come cell by cell."""
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            last = batch is None
            held += [] if last else [batch]
            if not sum(b.num_rows for b in held):
                continue
            part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cells = np.stack([part.column(k).to_numpy() for k in range(3)], axis=1)
            fresh = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1
            end = part.num_rows if last else int(fresh[-1]) if len(fresh) else 0
            held = [part.slice(end)]  # the last cell may go on
            if not end:
                continue
            cell = np.searchsorted(fresh, np.arange(end), side="right")
            within = cells[:end, 1] == cells[:end, 2]
            tree, block = part.column(3).to_numpy()[:end], part.column(4).to_numpy()[:end]
            names = part.column(5).slice(0, end)
            group = part.column(6).slice(0, end).dictionary_encode().indices.to_numpy()
            few = np.frombuffer(b"".join(part.column(7).slice(0, end).to_pylist()), np.uint8).reshape(end, HASHES)
            prefixes = np.frombuffer(b"".join(part.column(8).slice(0, end).to_pylist()), np.int64).reshape(end, TREES)
            fine = np.frombuffer(b"".join(part.column(9).slice(0, end).to_pylist()), np.uint64).reshape(end, FINE // 64)
            size_of = part.column(10).to_numpy()[:end].astype(np.float64)
            late, back = np.arange(end), 0
            found: list[tuple] = []
            size = 0
            while True:
                back += 1
                late = late[late >= back]
                late = late[cell[late] == cell[late - back]]
                if len(late):
                    x = late[(group[late] != group[late - back]) & (within[late] | (block[late] != block[late - back]))]
                    x = x[np.minimum(size_of[x], size_of[x - back]) >= threshold * np.maximum(size_of[x], size_of[x - back])]
                    share = (few[x] == few[x - back]).mean(axis=1)
                    estimate = (share - 1 / 256) / (1 - 1 / 256)
                    x, estimate = x[estimate >= least], estimate[estimate >= least]
                    finer = 1 - 2 * np.bitwise_count(fine[x] ^ fine[x - back]).sum(axis=1) / FINE
                    estimate = estimate + _FINE_WEIGHT * (finer - estimate)
                    good = estimate >= threshold - SURE_FINE
                    x, estimate = x[good], estimate[good]
                    earlier = (prefixes[x] == prefixes[x - back]) & (np.arange(TREES) < tree[x][:, None])
                    new = ~earlier.any(axis=1)
                    found.append((x[new], x[new] - back, estimate[new]))
                    size += len(found[-1][0])
                if found and (size > 20_000 or not len(late)):
                    x, y, e = (np.concatenate(c) for c in zip(*found, strict=True))
                    found, size = [], 0
                    if len(x):
                        yield pa.RecordBatch.from_arrays([names.take(pa.array(x)), names.take(pa.array(y)), pa.array(e)], names=["x", "y", "estimate"])
                if not len(late):
                    break

    return run


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class: the prefixes of all its trees, also in bytes, and 8 bits of every minhash."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            prefix = prefixes_of(part.column(1))
            few = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, HASHES).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(list(prefix), pa.list_(pa.int64())),
                    pa.array([p.tobytes() for p in prefix], pa.binary()),
                    pa.array([f.tobytes() for f in few], pa.binary()),
                ],
                names=["set_id", "list", "prefixes", "sketch"],
            )


def meeting(classes: DataFrame) -> DataFrame:
    """The classes that share a prefix with another one in some tree."""
    entries = classes.select("set_id", "signature").mapInArrow(_entries, "set_id binary, prefix long")
    shared = entries.groupBy("prefix").count().where("count > 1").select("prefix")
    found = join_growing(entries, shared, "prefix").select("set_id").distinct()
    return materialize(join_growing(classes, found, "set_id", "left_semi").select("set_id", "signature"))


def candidates(met: DataFrame, threshold: float, nearest: int) -> DataFrame:
    """(a, b, estimate) of each class's likeliest neighbours in some tree, at most TREES * nearest a class."""
    ordered = met.select("set_id", "signature").mapInArrow(_orders, "place binary, set_id binary, sketch binary").orderBy("place", "set_id")
    pairs = ordered.mapInArrow(_neighbours(threshold, nearest), "a binary, b binary, estimate double")
    return materialize(pairs.groupBy("a", "b").agg(F.max("estimate").alias("estimate")))


def with_roots(rows: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    """Adds the component of `node`, which is the node itself where it is linked with nothing."""
    named = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return join_growing(rows, named, node, "left").withColumn(root, F.coalesce(root, node))


def apart(met: DataFrame, sets: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(a, b, estimate) of the pairs that share a prefix in some tree, are not of one component and may reach the threshold, each pair once."""
    classes = materialize(
        with_roots(met.mapInArrow(_prefixes, "set_id binary, list array<long>, prefixes binary, sketch binary"), roots, "set_id", "root")
    )
    entries = classes.select("set_id", "root", F.posexplode("list").alias("tree", "prefix"))
    # Only regions of two components or more; their size says into how many blocks they are cut.
    sizes = entries.groupBy("prefix").agg(F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s")).where("r != s")
    sizes = sizes.select("prefix", F.ceil(F.col("n") / CELL).cast("int").alias("blocks"))
    placed = materialize(join_growing(entries.drop("root"), sizes, "prefix").withColumn("block", F.pmod(F.xxhash64("set_id"), "blocks").cast("int")))
    fine = join_growing(sets, placed.select("set_id").distinct(), "set_id", "left_semi")
    fine = join_growing(fine.mapInArrow(_fine, "set_id binary, fine binary"), sets.select("set_id", F.size("shingles").alias("n")), "set_id")
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("prefix", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "tree", "block", "set_id")
    named = materialize(join_growing(classes.drop("list"), fine, "set_id"))
    full = join_growing(dealt, named, "set_id").select("prefix", "low", "high", "tree", "block", "set_id", "root", "sketch", "prefixes", "fine", "n")
    cells = full.repartition("prefix", "low", "high").sortWithinPartitions("prefix", "low", "high")
    pairs = cells.mapInArrow(_apart(threshold), "x binary, y binary, estimate double")
    return materialize(pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"), "estimate"))


def linked_apart(pairs: DataFrame, sets: DataFrame, links: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(node, root) after all of `pairs` (a, b, estimate) that join two components were confirmed, the best ones first."""
    quota = FIRST
    while True:
        rest = with_roots(with_roots(pairs, roots, "a", "root_a"), roots, "b", "root_b").where("root_a != root_b")
        order = [F.desc("estimate"), F.col("a"), F.col("b")]
        for own, other in (("a", "root_b"), ("b", "root_a")):
            rest = rest.withColumn(f"rank_{own}", F.row_number().over(Window.partitionBy(own, other).orderBy(*order)))
        rest = materialize(rest.select("a", "b", "estimate", F.greatest("rank_a", "rank_b").alias("rank")))
        if rest.isEmpty():
            return roots
        found = confirmed(rest.where(F.col("rank") <= quota), sets, threshold)
        pairs, quota = rest.where(F.col("rank") > quota).drop("rank"), 1 << 60
        if not found.isEmpty():
            links = links.union(found)
            roots = materialize(components(links))


def _reaching(percent: int):
    def run(pairs: pa.Table, needed: pa.Table) -> pa.Table:
        """The pairs of one cell whose full sets reach the threshold."""
        place = {name: k for k, name in enumerate(needed["set_id"].to_pylist())}
        column = needed["shingles"].combine_chunks()
        sizes = column.value_lengths().to_numpy()
        values = np.unique(column.flatten().to_numpy(), return_inverse=True)[1].ravel()
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        a = np.array([place[x] for x in pairs["a"].to_pylist()], np.int64)
        b = np.array([place[x] for x in pairs["b"].to_pylist()], np.int64)
        order = np.argsort(a, kind="stable")
        good = np.zeros(len(a), bool)
        marked = np.zeros(int(values.max()) + 1 if len(values) else 0, bool)
        for own in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
            if not len(own):
                continue
            mine = values[bounds[a[own[0]]] : bounds[a[own[0]] + 1]]
            marked[mine] = True
            for k in own:
                both = int(np.count_nonzero(marked[values[bounds[b[k]] : bounds[b[k] + 1]]]))
                good[k] = 100 * both >= percent * (len(mine) + int(sizes[b[k]]) - both)
            marked[mine] = False
        return pairs.select(["a", "b"]).filter(pa.array(good))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs that reach the threshold on their full sets."""
    pairs = materialize(pairs.select("a", "b"))
    ends = pairs.select(F.col("a").alias("set_id")).union(pairs.select(F.col("b").alias("set_id")))
    n = pairs.count()
    # Cells of pairs with the sets they need: a set is sent once to each cell, however many pairs it has there.
    across = max(1, min(-(-ends.distinct().count() // BLOCK_SETS), math.isqrt(n // CELL_PAIRS)))
    dealt = pairs.withColumns({c: F.pmod(F.xxhash64(e), F.lit(across)) for c, e in (("row", "a"), ("column", "b"))})
    needed = dealt.select(F.col("row").alias("r"), F.col("column").alias("c"), F.explode(F.array("a", "b")).alias("set_id"))
    both = dealt.groupBy("row", "column").cogroup(join_growing(needed.distinct(), sets, "set_id").groupBy("r", "c"))
    return materialize(both.applyInArrow(_reaching(round(100 * threshold)), "a binary, b binary"))


def marks_of(ids: DataFrame) -> np.ndarray:
    """A table of MARKS bits, set at the text_ids."""
    place = F.pmod("text_id", F.lit(MARKS))
    words = ids.groupBy(F.floor(place / 32).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(text_id, {MARKS}) % 32 as int))")).alias("bits"))
    table = np.zeros(MARKS // 32, np.uint32)
    for r in words.collect():  # MARKS / 32 rows at most
        table[r["word"]] = r["bits"]
    return np.unpackbits(table.astype("<u4").view(np.uint8), bitorder="little")


def _marked(marks: np.ndarray):
    packed_marks = np.packbits(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(packed_marks).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(table[batch.column(1).to_numpy() % MARKS]))

    return run


def near_classes(docs: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_id, n_shingles, set_id) of every row, and (node, root) of the classes that are linked with others."""
    signed = materialize(
        docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text").mapInArrow(
            _signatures,
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_id long, n_shingles long, set_id binary, signature binary",
        )
    )
    classes = signed.where("n_shingles > 0").groupBy("set_id").agg(F.any_value("signature").alias("signature"))
    met = meeting(materialize(classes))
    # One row for each class that met another one; its set is made again from the whole text.
    met_rows = join_growing(signed.select("doc_id", "text_id", "set_id"), met.select("set_id"), "set_id", "left_semi")
    place = ["text_id", "owner"]  # doc_id hashed: a null is a value like others, and one shuffle by these keys serves the join and the distinct rows
    owners = met_rows.groupBy("set_id").agg(F.min(F.struct("text_id", F.xxhash64("doc_id").alias("owner"))).alias("o")).select("o.*").distinct()
    owners = materialize(owners)
    hashed = docs.where("text is not null").select(F.xxhash64("doc_id").alias("owner"), F.xxhash64("text").alias("text_id"), "text")
    kept = hashed.mapInArrow(_marked(marks_of(owners)), "owner long, text_id long, text string")
    texts = join_growing(kept, owners, place, "left_semi").dropDuplicates(place)
    sets = materialize(texts.select("text").mapInArrow(_sets, "set_id binary, shingles array<long>"))
    nearest = candidates(met, threshold, NEAREST)
    best = nearest.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))
    links = confirmed(best, sets, threshold)
    roots = materialize(components(links))
    return signed, linked_apart(apart(met, sets, roots, threshold), sets, links, roots, threshold)


def judged(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """doc_id, text_id (a hash of the text), n_shingles, component_id and kept for every row of (doc_id, text)."""
    signed, roots = near_classes(docs, threshold)
    rows = join_growing(signed.drop("signature"), roots.withColumnRenamed("node", "set_id"), "set_id", "left")
    rows = rows.withColumn("part", F.when(F.col("n_shingles") > 0, F.coalesce("root", "set_id")))
    least = materialize(rows.where("part is not null").groupBy("part").agg(F.min("doc_id").alias("least")))
    named = join_growing(rows, least, "part", "left").withColumn("component_id", F.coalesce("least", "doc_id"))
    return named.select("doc_id", "text_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    return judged(docs, threshold).drop("text_id")


def keep_first(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """The documents without those that are linked, directly or by others, with a document of smaller doc_id.

    Rows that repeat both doc_id and text are one document and stay or go together.
    """
    gone = judged(docs, threshold).where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_id").alias("gone_text")).distinct()
    rows = packed(docs, id=F.col("doc_id"), text_id=F.xxhash64("text"))
    stay = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_id") == F.col("gone_text")), "left_anti")
    return unpacked(stay)
