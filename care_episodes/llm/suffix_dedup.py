"""Removal of repeated 100-byte strings, with a cover sample of the suffixes instead of all of them.

Every text is a byte string; a byte goes when a `LENGTH`-byte string that covers it also starts earlier: in a document of
smaller doc_id, or earlier in the same one.  Strings are judged on the input.  A suffix array compares suffixes to depth
`LENGTH` here, and only equality matters.  As in difference-cover construction, a sample of positions is ranked first, so that
any two equal strings meet at sampled positions at one and the same distance from their starts, and what lies between is
compared directly.  The cover is taken by content: a suffix's cover position is where the hash of `GRAM` bytes is smallest
(leftmost on ties) within its first `LENGTH` bytes.  Equal strings choose the same distance, as a difference cover promises,
while only 2.6 % of all positions are in the sample (a cover modulo 57 that leaves as long a common part has 14 %).

1. Cover sample: each sampled position with the run of suffixes that chose it.  The bucket of a sampled position is the hash
   of its gram.  The sample is dealt out by bucket and sorted, so that each task goes through one bucket after the other.
2. Ranks: members of a bucket whose whole runs are equal (same length, same place of the cover position, same bytes) get one
   rank.  All but the first place of a rank are repeated as a whole, which settles the long ties: texts copied at length.
3. The first members of the ranks are compared suffix by suffix, one bucket at a time, if their bucket has several ranks.
   Suffixes to depth `LENGTH` are told apart by hash beside the bucket; all but the first place of a class are repeated.
4. The runs of each document are merged and taken out of its bytes.

Buckets that many documents share (found in a sample of documents, which decides nothing but the route) are dealt out by bucket
and run in step 2; in step 3 their suffixes are grouped one by one with minima that combine on the map side.

Grams, runs and suffixes are compared by hashes inside a bucket that is itself a 64-bit hash: 64 + 40 bits for runs (24 more say
whether the first or last half of a run occurs twice, and only save work), 64 + 64 for suffixes.

Defined results: null text has 0 bytes and the hash of the empty string; texts under 100 bytes lose nothing.  Rows that repeat
both doc_id and text share every place, so none is earlier than the other and they lose the same bytes; different texts under one
doc_id stand in the order of their md5.  A null doc_id is smaller than any other.

Scale: one row of 32 bytes for each 39 bytes of text is shuffled once, after rows that repeat within a part of a task are
settled.  Texts are shuffled compressed.  They are handled in pieces of `PIECE` bytes, so memory is bounded by a text and a few
arrays of a piece.  Ids that are no whole numbers, or have several texts, cost a numbering of all texts by ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from care_episodes.functions.scan import null_safe_join, ordered_parts, running_sums
from care_episodes.llm.buffers import slices, utf8
from care_episodes.llm.words import mixed, powers
from care_episodes.session import materialize

LENGTH, GRAM = 100, 24
WINDOW = LENGTH - GRAM + 1
PIECE = 1 << 20
TEXT_BITS = 18
#: Sample rows that are looked at together for runs that repeat within a task.
TOGETHER = 300_000
#: A bucket with this many rows in one of SPARSE documents is shared by many.
SPARSE, MANY = 64, 64
HALF = 38
_BASE = 0xD6E8FEB86659FD93


class Prefix:
    """Hashes of any run of a byte array."""

    def __init__(self, data: np.ndarray, power: np.ndarray, inverse: np.ndarray):
        value = (data.astype(np.uint64) + np.uint64(1)) * power[: len(data)]
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        self.inverse = inverse

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.total[b] - self.total[a]) * self.inverse[a])


def tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(size), powers(size, pow(_BASE, -1, 1 << 64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    parts = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(parts, axis=1).ravel()
    behind = np.minimum.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def cover_sample(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first suffix, last suffix, cover position - first suffix, bucket, run hash); places are within the row."""
    power, inverse = tables(min(len(data), PIECE + LENGTH) + 1)
    for start in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        part = data[start : start + PIECE + LENGTH - 1]
        prefix = Prefix(part, power, inverse)
        at = np.arange(len(part) - GRAM + 1)
        gram = prefix.run(at, at + GRAM)
        key = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        chosen = (sliding_min(key, WINDOW) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # Suffixes that have LENGTH bytes within their row.
        change = np.zeros(len(chosen) + 1, np.int32)
        low = np.clip(offsets[:-1] - start, 0, len(chosen))
        high = np.clip(np.maximum(offsets[1:] - LENGTH + 1 - start, low), 0, len(chosen))
        np.add.at(change, low, 1)
        np.add.at(change, high, -1)
        valid = np.cumsum(change[:-1]) > 0
        fresh = valid.copy()
        fresh[1:] &= ~valid[:-1] | (chosen[1:] != chosen[:-1])
        first = np.flatnonzero(fresh)
        ends = valid.copy()
        ends[:-1] &= ~valid[1:] | (chosen[1:] != chosen[:-1])
        last = np.flatnonzero(ends)
        if len(first):
            cover = chosen[first]
            shape = ((cover - first) * LENGTH + (last - first)).astype(np.uint64)
            run = mixed(prefix.run(first, last + LENGTH) + shape * np.uint64(0x9E3779B97F4A7C15))
            # What any suffix starting at most HALF before the cover position holds, and what any other one holds (within the run).
            right = prefix.run(cover, np.minimum(cover + LENGTH - HALF, last + LENGTH)) >> np.uint64(52)
            left = prefix.run(np.maximum(cover - HALF, first), cover + GRAM) >> np.uint64(52)
            run = (run & np.uint64(0xFFFFFFFFFF000000)) | (right << np.uint64(12)) | left
            row = np.searchsorted(offsets, first + start, side="right") - 1
            base = offsets[row] - start
            yield row, first - base, last - base, cover - first, gram[cover], run


def pack(place: np.ndarray, reach: np.ndarray, length: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Place (31 bits), cover position less place (7), length of the run less 1 (7) and the text's bits in a long that sorts by place."""
    return (place << 32) | (reach << (TEXT_BITS + 7)) | (length << TEXT_BITS) | text


def place_of(at: np.ndarray) -> np.ndarray:
    return at >> 32


def reach_of(at: np.ndarray) -> np.ndarray:
    return (at >> (TEXT_BITS + 7)) & 0x7F


def length_of(at: np.ndarray) -> np.ndarray:
    return (at >> TEXT_BITS) & 0x7F


def text_of(at: np.ndarray) -> np.ndarray:
    return at & ((1 << TEXT_BITS) - 1)


def _numbers(column: pa.Array) -> np.ndarray:
    """doc_id as numbers that sort as places do: null first."""
    return column.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    """doc_id comes back as null where it was null."""
    arrays = {k: pa.array(v) for k, v in columns.items()}
    if "doc_id" in columns:
        arrays["doc_id"] = pa.array(columns["doc_id"], mask=columns["doc_id"] == np.iinfo(np.int64).min)
    return pa.RecordBatch.from_pydict(arrays)


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample; rows known to be repeated have `done` set and a bucket of their own."""
    kept: list[tuple[np.ndarray, ...]] = []
    held = 0
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column(2))
        text = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = _numbers(batch.column(0))
        for row, first, last, reach, bucket, run in cover_sample(data, offsets):
            kept.append((bucket.view(np.int64), run.view(np.int64), ids[row], pack(first, reach, last - first, text[row])))
            held += len(row)
        if held >= TOGETHER:
            yield _settled(kept)
            kept, held = [], 0
    if kept:
        yield _settled(kept)


def _settled(kept: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    bucket, run, ids, at = (np.concatenate(c) for c in zip(*kept, strict=True))
    order = np.lexsort((at, ids, run, bucket))
    bucket, run, ids, at = bucket[order], run[order], ids[order], at[order]
    done = _repeats(bucket, run >> 24, ids, at)
    bucket = np.where(done, mixed((ids * 1_000_003 + at).view(np.uint64)).view(np.int64), bucket)
    return _batch(bucket=bucket, run=run, doc_id=ids, at=at, done=done)


def _repeats(bucket: np.ndarray, name: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of rows sorted by bucket, name and place: those whose class has an earlier place.  Equal places are not earlier."""
    fresh = np.ones(len(bucket), bool)
    fresh[1:] = (bucket[1:] != bucket[:-1]) | (name[1:] != name[:-1])
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(bucket)), 0))
    return (ids != ids[head]) | (place_of(at) != place_of(at[head]))


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through sorted buckets.  Returns repeated runs (done), and first members whose bucket has several ranks."""
    for columns in _whole_buckets(batches, ("bucket", "run", "doc_id", "at", "done", "shared")):
        bucket, run, ids, at, done, shared = columns
        again = done | _repeats(bucket, run >> 24, ids, at)
        first = ~again
        first[1:] &= ~((bucket[1:] == bucket[:-1]) & (run[1:] >> 24 == run[:-1] >> 24))
        k = np.flatnonzero(first)
        right, left = (_twice(bucket[k], half) | shared[k] for half in ((run[k] >> 12) & 0xFFF, run[k] & 0xFFF))
        # Suffixes that start at most HALF before the cover position need the right half, the others the left one.
        place, reach, length = place_of(at[k]), reach_of(at[k]), length_of(at[k])
        low = np.where(left, 0, np.maximum(reach - HALF, 0))
        high = np.where(right, length, np.minimum(length, reach - HALF - 1))
        some = low <= high
        rest = pack(place + low, np.maximum(reach - low, 0), high - low, text_of(at[k]))[some]
        k = k[some]
        out = np.concatenate([np.flatnonzero(again), k])
        yield _batch(
            bucket=bucket[out], doc_id=ids[out], at=np.concatenate([at[again], rest]), done=np.arange(len(out)) < again.sum(), shared=shared[out]
        )


def _twice(bucket: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Whether another row has the same bucket and name."""
    order = np.lexsort((name, bucket))
    b, n = bucket[order], name[order]
    same = np.zeros(len(b) + 1, bool)
    same[1:-1] = (b[1:] == b[:-1]) & (n[1:] == n[:-1])
    out = np.zeros(len(b), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _whole_buckets(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """The columns of sorted rows, cut where the bucket changes.  A bucket shared by many need not be whole."""
    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        at = {n: k for k, n in enumerate(batch.schema.names)}
        fresh = [_numbers(batch.column(at[n])) if n == "doc_id" else batch.column(at[n]).to_numpy(zero_copy_only=False) for n in names]
        held = [np.concatenate([a, b]) for a, b in zip(held, fresh, strict=True)] if held else fresh
        cut = int(np.searchsorted(held[0], held[0][-1], side="left"))
        if cut:
            yield [c[:cut] for c in held]
            held = [c[cut:] for c in held]
    if held:
        yield held


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, for the way through the shuffle."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column(2))
        texts = [codec.compress(data[a:b].tobytes(), asbytes=True) if b > a else b"" for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(offsets)), pa.array(texts, pa.binary())], names=["doc_id", "bits", "n_bytes", "squeezed"]
        )


def _texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    codec = pa.Codec("zstd")
    for size, squeezed in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
        yield np.frombuffer(codec.decompress(squeezed.as_buffer(), decompressed_size=size), np.uint8) if size else np.zeros(0, np.uint8)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each listed run the hashes of its suffixes to depth LENGTH."""
    power, _ = tables(LENGTH)
    for batch in batches:
        ids = _numbers(batch.column(0))
        for i, (text, runs) in enumerate(zip(_texts(batch), batch.column(3), strict=True)):
            flat = runs.values
            at, bucket, shared = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "bucket", "shared"))
            for start in range(0, len(at), 4000):
                part = slice(start, start + 4000)
                n = length_of(at[part]) + 1
                ends = np.cumsum(n)
                begin = np.repeat(place_of(at[part]) - (ends - n), n) + np.arange(ends[-1])
                hashed = np.zeros(len(begin), np.uint64)
                for j in range(LENGTH):
                    hashed += (text[begin + j].astype(np.uint64) + np.uint64(1)) * power[j]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(mixed(hashed).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[part]), pa.array(np.full(len(n), ids[i]), mask=np.full(len(n), ids[i] == np.iinfo(np.int64).min)),
                        pa.array(at[part]), pa.array(shared[part]), lists,
                    ],
                    names=["bucket", "doc_id", "at", "shared", "suffixes"],
                )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of sorted buckets, one bucket after the other: runs of those that stand earlier."""
    for bucket, ids, at, lists in _whole_buckets(batches, ("bucket", "doc_id", "at", "suffixes")):
        n = length_of(at) + 1
        which = np.repeat(np.arange(len(at)), n)
        suffix = np.concatenate(lists)
        place = place_of(at)[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        spot = place << 32
        order = np.lexsort((spot, ids[which], suffix, bucket[which]))
        gone = np.zeros(len(which), bool)
        gone[order] = _repeats(bucket[which][order], suffix[order], ids[which][order], spot[order])
        # Neighbouring suffixes of one run become one run again.
        k = np.flatnonzero(gone)
        fresh = np.ones(len(k), bool)
        fresh[1:] = (which[k[1:]] != which[k[:-1]]) | (k[1:] != k[:-1] + 1)
        start = np.flatnonzero(fresh)
        end = np.append(start[1:], len(k)) - 1
        w = which[k[start]]
        if len(start):
            yield _batch(doc_id=ids[w], at=pack(place[k[start]], np.zeros(len(w), np.int64), k[end] - k[start], text_of(at[w])))


def merged(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of [place, place + length + LENGTH) of packed runs."""
    runs = np.sort(runs)
    start = place_of(runs)
    end = np.maximum.accumulate(start + length_of(runs) + LENGTH)
    fresh = np.ones(len(runs), bool)
    fresh[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(fresh)
    return start[at], end[np.append(at[1:], len(runs)) - 1]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone, spans, digests = [], [], []
        for text, runs in zip(_texts(batch), batch.column(3), strict=True):
            starts, ends = merged(np.asarray(runs.values)) if runs.is_valid and len(runs.values) else (np.zeros(0, np.int64),) * 2
            kept = hashlib.sha256()
            at = 0
            for a, b in zip(starts, ends, strict=True):
                kept.update(text[at:a].tobytes())
                at = b
            kept.update(text[at:].tobytes())
            gone.append(int((ends - starts).sum()))
            spans.append(len(starts))
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def text_bits() -> Column:
    return F.coalesce(F.xxhash64("text").bitwiseAND((1 << TEXT_BITS) - 1), F.lit(0))


def of_text(rows: DataFrame, *more: str) -> DataFrame:
    """The runs of each text: (of, of_bits, runs); a text's runs are bounded by its length."""
    key = F.col("at").bitwiseAND((1 << TEXT_BITS) - 1).alias("of_bits")
    return rows.groupBy(F.col("doc_id").alias("of"), key).agg(F.collect_list(F.struct("at", *more) if more else F.col("at")).alias("runs"))


def repeated_runs(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, at) of runs of suffixes that stand earlier; `at` is packed."""
    long_enough = docs.where(F.octet_length("text") >= LENGTH).select(F.col("doc_id").cast("long").alias("doc_id"), text_bits().alias("bits"), "text")
    schema = "bucket long, run long, doc_id long, at long, done boolean"
    some = long_enough.where(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(SPARSE)) == 0).mapInArrow(_cover, schema)
    many = materialize(some.groupBy("bucket").count().where(F.col("count") >= MANY).select(F.col("bucket").alias("many")))
    cover = long_enough.mapInArrow(_cover, schema).join(many, F.col("bucket") == F.col("many"), "left")
    cover = cover.withColumn("shared", F.col("many").isNotNull()).drop("many")
    part = F.when(F.col("shared"), F.shiftright("run", 24)).otherwise(F.lit(0))
    ranked = materialize(
        cover.repartition("bucket", part).sortWithinPartitions("bucket", "run", "doc_id", "at")
        .mapInArrow(_ranked, "bucket long, doc_id long, at long, done boolean, shared boolean")
    )
    left = of_text(ranked.where("not done"), "bucket", "shared")
    joined = texts.join(left, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("bits") == F.col("of_bits")))
    suffixes = materialize(
        joined.select("doc_id", "n_bytes", "squeezed", "runs").mapInArrow(_suffixes, "bucket long, doc_id long, at long, shared boolean, suffixes array<long>")
    )
    few = (
        suffixes.where("not shared").select("bucket", "doc_id", "at", "suffixes").repartition("bucket").sortWithinPartitions("bucket", "doc_id", "at")
        .mapInArrow(_compared, "doc_id long, at long")
    )
    one = suffixes.where("shared").select("bucket", "doc_id", F.col("at").bitwiseAND((1 << TEXT_BITS) - 1).alias("bits"), F.shiftright("at", 32).alias("start"), F.posexplode("suffixes").alias("k", "suffix"))
    one = one.select("bucket", "suffix", "doc_id", "bits", (F.col("start") + F.col("k")).alias("place"))
    place = F.struct("doc_id", "place")
    classes = one.groupBy("bucket", "suffix").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    of_many = one.join(classes, ["bucket", "suffix"]).where(F.col("first") < place).select(
        "doc_id", F.expr("shiftleft(place, 32)").bitwiseOR(F.col("bits")).alias("at")
    )
    return ranked.where("done").select("doc_id", "at").union(few).union(of_many)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Where an id has several texts, or is no whole number, texts are numbered by (doc_id, md5 of the text) first, and
    that is their order.
    """
    ids = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("hash"))
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        several = ids.groupBy("doc_id").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a <> b")
        if several.isEmpty():
            return _remove(docs.select("doc_id", "text"))
    order = ["doc_id", "hash"]
    numbered = materialize(running_sums(ordered_parts(ids.distinct(), [], order), [], order, {"number": F.lit(1).cast("long")}).select(*order, "number"))
    rows = null_safe_join(docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("hash")), numbered, order, "inner")
    found = _remove(rows.select(F.col("number").alias("doc_id"), "text")).withColumnRenamed("doc_id", "number")
    return found.join(numbered, "number").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _remove(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bits().alias("bits"), "text").mapInArrow(
        _squeezed, "doc_id long, bits long, n_bytes long, squeezed binary"
    )
    runs = of_text(repeated_runs(docs, texts))
    rows = texts.join(runs, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("bits") == F.col("of_bits")), "left")
    found = rows.select("doc_id", "n_bytes", "squeezed", "runs").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
