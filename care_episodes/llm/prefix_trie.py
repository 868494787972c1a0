"""Prefix trie of conversations: which openings conversations share, from sorted sequences and range minima of common prefixes.

**Sequences.**  A turn is the hash of its place, role and text.  Conversations are cut into chunks of `CHUNK` turns, so a row is bounded
however long a conversation is; a chunk belongs to the prefix before it (the exclusive-or of the hashes of its turns, which
name their places).  Rows are sorted by (chunk number, prefix before, turns), dealt out by range: chunks that share a prefix stand side by side.

**Intervals.**  A task takes its sorted rows in blocks.  Common prefix lengths of neighbours go into a sparse table of range minima; every
candidate prefix (row, length) then finds how far it reaches to the left and to the right by binary search in that table, each for
itself, and the interval's members give count, smallest id and longest length (sparse tables too) and sums (prefix sums).  The candidate that
reaches no further left than its own row stands for the node.  Intervals that touch a block's edge are pieces of a node: pieces of
one prefix are added up; there are at most 2 * `CHUNK` per block.

**Sums over subtrees** come from members.  A node is counted at its smallest member, so the bytes of a subtree's nodes are a sum over
members, less what the top's smallest member counts above it; the bytes before sharing are another.  A first run finds what each
conversation counts, a second one takes the sums over the same intervals.

Lists of members that end at a node are hashed piece by piece: runs of `RUN` ids are written out where they lie sorted, and one task joins
the runs of a list in order, never holding the list.

Skew: a long conversation is many chunks; a first turn shared by very many is one node made of one piece per block.  Turns are numbered by
sums over ranges, not by a window over a conversation.

Defined results: null roles and texts are empty.  Turns of equal number stand in order of role, then text (the first 64 characters, then
the hash).  Repeated rows are turns.  Turns without a conv_id belong to no conversation and are left out.  Extra columns are not
read.  An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from care_episodes.functions.scan import ordered_parts, running_sums
from care_episodes.session import materialize

#: Turns in a chunk, rows in a block, ids in a run.
CHUNK, BLOCK_ROWS, RUN = 64, 8192, 4096
#: Turns taken over from another conversation are fewer than this.
HEADS = 9

_KEY = ("depth", "k1", "k2")
_PIECE = "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n long, longest long, before long, size long, gain long, leaf long, edge boolean"


# ---- sequences ------------------------------------------------------------------------------
def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn hash, bytes of the text) of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), F.substring(text, 1, 64).alias("opening"),
        F.md5(F.concat(F.length(role), F.lit(":"), role, text)).alias("hash"), F.octet_length(text).cast("long").alias("size"),
    )
    order = ["turn", "role", "opening", "hash"]
    parts = ordered_parts(turns, ["conv_id"], order)
    return running_sums(parts, ["conv_id"], order, {"pos": F.lit(1).cast("long")}).select("conv_id", "pos", "hash", "size")


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes from the one it is based on: crc32 of its decimal id, modulo 9."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, hash, size, length), (conv_id, length)) with the first turns of conv_id - conv_id % 5 in place of the own ones."""
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    plan = counts.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), borrowed(F.col("conv_id")).alias("h"))
    base = counts.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    taken = F.least("h", F.coalesce("of_base", F.lit(0)))
    plan = materialize(
        plan.join(base, "base", "left").select(
            "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")
        )
    )
    heads = turns.where(F.col("pos") < HEADS).withColumnRenamed("conv_id", "base").join(plan, "base").where("pos <= h")
    own = turns.join(plan, "conv_id").where("pos > h")
    both = heads.select("conv_id", F.col("pos").alias("depth"), "hash", "size", "length").unionByName(
        own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "hash", "size", "length")
    )
    placed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("hash")))
    return both.withColumn("hash", placed), plan.select("conv_id", "length")


def _half(digest: Column, start: int) -> Column:
    """64 bits of a hex digest as a long."""
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def chunk_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, p1, p2, before, hashes, sizes, length, x1, x2, bytes): up to CHUNK turns a row, with the prefix before them."""
    turns = turns.withColumns({"x1": _half(F.col("hash"), 1), "x2": _half(F.col("hash"), 17)})
    listed = F.sort_array(F.collect_list(F.struct("depth", "hash", "size")))
    rows = turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / CHUNK).alias("chunk")).agg(
        listed.alias("turns"), F.max("length").alias("length"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("size").alias("bytes")
    )
    rows = materialize(
        rows.select("conv_id", "chunk", F.array_join("turns.hash", "").alias("hashes"), F.col("turns.size").alias("sizes"), "length", "x1", "x2", "bytes")
    )
    names = ["conv_id", "chunk", "p1", "p2", "before", "hashes", "sizes", "length", "x1", "x2", "bytes"]
    zero = F.lit(0).cast("long")
    short = rows.where(F.col("length") <= CHUNK).withColumns({"p1": zero, "p2": zero, "before": zero})
    parts = ordered_parts(rows.where(F.col("length") > CHUNK), ["conv_id"], ["chunk"])
    long = running_sums(parts, ["conv_id"], ["chunk"], {"sum": F.col("bytes")}, {"s1": F.col("x1"), "s2": F.col("x2")})
    long = long.withColumns({"p1": F.col("s1").bitwiseXOR(F.col("x1")), "p2": F.col("s2").bitwiseXOR(F.col("x2")), "before": F.col("sum") - F.col("bytes")})
    return materialize(short.select(names).unionByName(long.select(names)))


# ---- intervals ------------------------------------------------------------------------------
class SparseTable:
    """Range minima (or maxima) of any range in two look-ups."""

    def __init__(self, values: np.ndarray, how=np.minimum):
        self.how, self.levels, step = how, [values], 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(how(last[: len(last) - step], last[step:]))
            step *= 2

    def over(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of values[first..last], ends included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            m = level == k
            out[m] = self.how(self.levels[k][first[m]], self.levels[k][last[m] + 1 - (1 << int(k))])
        return out


def left_extents(common: SparseTable, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Smallest row from which all neighbours up to `at` share at least `length`; common[i] is between rows i - 1 and i."""
    at = at.copy()
    for k in range(len(common.levels) - 1, -1, -1):
        level, step = common.levels[k], 1 << k
        start = at - step + 1
        reach = (start >= 1) & (level[np.maximum(start, 0)] >= length)
        at[reach] -= step
    return at


def right_extents(common: SparseTable, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Largest row up to which all neighbours from `at` on share at least `length`."""
    at = at.copy()
    n = len(common.levels[0])
    for k in range(len(common.levels) - 1, -1, -1):
        level, step = common.levels[k], 1 << k
        reach = (at + step < n) & (level[np.minimum(at + 1, len(level) - 1)] >= length)
        at[reach] += step
    return at


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])


def _cells(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def block_pieces(rows: pa.Table) -> dict[str, np.ndarray]:
    """The distinct prefixes of a block of sorted rows, each with what its members in the block add up to."""
    rows = rows.combine_chunks()
    n = rows.num_rows
    turns = np.frombuffer(bytes.fromhex("".join(rows["hashes"].to_pylist())), ">i8").astype(np.int64).reshape(-1, 2)
    sizes = rows["sizes"].combine_chunks()
    counts = _cells(sizes.value_lengths()).astype(np.int64)
    sizes = _cells(sizes.flatten()).astype(np.int64)
    start = _running(counts)
    row = np.repeat(np.arange(n), counts)
    place = np.arange(len(row)) - start[row]  # of a turn in its row, from 0
    group = np.stack([_cells(rows[c].combine_chunks()) for c in ("chunk", "p1", "p2")], 1)
    # Common prefix of each row with the one before it, 0 where the groups differ or nothing stands before.
    same_group = np.concatenate([[False], (group[1:] == group[:-1]).all(1)])
    shared = np.where(same_group, np.minimum(counts, np.concatenate([[0], counts[:-1]])), 0)
    compared = place < shared[row]
    here = np.flatnonzero(compared)
    there = start[row[here] - 1] + place[here]
    differ = here[(turns[here] != turns[there]).any(1)]
    common = shared.copy()
    np.minimum.at(common, row[differ], place[differ])
    table = SparseTable(common)
    # Every prefix of every row looks for its own interval.
    length = place + 1
    left = left_extents(table, row, length)
    mine = np.flatnonzero(left == row)
    row, length, left = row[mine], length[mine], left[mine]
    right = right_extents(table, row, length)
    column = {c: _cells(rows[c].combine_chunks()) for c in ("conv_id", "length", "chunk", "before", "gain", "leaf", "p1", "p2")}
    out = {"n": right - left + 1, "conv_id": SparseTable(column["conv_id"]).over(left, right)}
    out["longest"] = SparseTable(column["length"], np.maximum).over(left, right)
    out["depth"] = column["chunk"][row] * CHUNK + length
    for k, (half, own) in enumerate((("1", "p1"), ("2", "p2"))):
        total = np.concatenate([[0], np.bitwise_xor.accumulate(turns[:, k])]) if len(turns) else np.zeros(1, np.int64)
        base = total[start[row]] ^ column[own][row]
        out[f"k{half}"] = total[mine + 1] ^ base
        out[f"p{half}"] = total[mine] ^ base
    bytes_ = _running(sizes)
    out["size"] = sizes[mine]
    out["before"] = column["before"][row] + bytes_[mine] - bytes_[start[row]]
    for c in ("gain", "leaf"):
        total = _running(column[c])
        out[c] = total[right + 1] - total[left]
    out["edge"] = (left == 0) | (right == n - 1)
    return out


def trie_pieces(chunks: DataFrame) -> DataFrame:
    """Nodes and pieces of nodes; `chunks` has columns gain and leaf to be summed over members."""
    schema = to_arrow_schema(StructType.fromDDL(_PIECE), prefers_large_types=False)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: list) -> pa.RecordBatch:
            found = block_pieces(pa.Table.from_batches(block))
            return pa.RecordBatch.from_arrays([pa.array(found[f.name]).cast(f.type) for f in schema], schema=schema)

        block, n = [], 0
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, BLOCK_ROWS - n)
                batch = batch.slice(some.num_rows)
                block.append(some)
                n += some.num_rows
                if n == BLOCK_ROWS:
                    yield out(block)
                    block, n = [], 0
        if block:
            yield out(block)

    order = ["chunk", "p1", "p2", "hashes", "conv_id"]
    ranged = chunks.select(*order, "before", "sizes", "length", "gain", "leaf").repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(pieces, _PIECE)


def trie_nodes(chunks: DataFrame) -> DataFrame:
    """One row per node below the root."""
    pieces = materialize(trie_pieces(chunks))
    joined = pieces.where("edge").groupBy(*_KEY).agg(
        *[F.first(c).alias(c) for c in ("p1", "p2", "before", "size")], F.min("conv_id").alias("conv_id"), F.max("longest").alias("longest"),
        *[F.sum(c).alias(c) for c in ("n", "gain", "leaf")],
    )
    names = [c for c in pieces.columns if c != "edge"]
    return pieces.where("not edge").select(names).unionByName(joined.select(names))


# ---- lists of members -----------------------------------------------------------------------
def ends_hashes(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) from (depth, k1, k2, conv_id): the SHA-256 of the ids in order, comma-joined."""
    runs_ddl = "depth long, k1 long, k2 long, first long, ids string"
    sha_ddl = "depth long, k1 long, k2 long, ends_sha256 string"
    runs_schema, sha_schema = (to_arrow_schema(StructType.fromDDL(d), prefers_large_types=False) for d in (runs_ddl, sha_ddl))

    def keyed(batch: pa.RecordBatch) -> tuple[np.ndarray, list[int]]:
        key = np.stack([_cells(batch.column(c)) for c in range(3)], 1)
        return key, [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key, cuts = keyed(batch)
            ids = batch.column(3).to_pylist()
            found = [(a, min(a + RUN, b)) for s, b in zip(cuts[:-1], cuts[1:], strict=True) for a in range(s, b, RUN)]
            first = np.array([a for a, _ in found])
            columns = [*key[first].T, np.array([ids[a] for a, _ in found])]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([",".join(map(str, ids[a:b])) for a, b in found])], schema=runs_schema)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for batch in batches:
            done = []
            keys = zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
            for key, ids in zip(keys, batch.column(4).to_pylist(), strict=True):
                if key == last:
                    sha.update(b",")
                else:
                    if sha is not None:
                        done.append((*last, sha.hexdigest()))
                    last, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=sha_schema)
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*last, sha.hexdigest())], schema=sha_schema)

    order = [*_KEY, "conv_id"]
    listed = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(runs, runs_ddl)
    return listed.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(hashes, sha_ddl)


# ---- the trie -------------------------------------------------------------------------------
def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, plan = rebuilt_turns(materialize(numbered_turns(conversations)))
    chunks = chunk_rows(turns)
    zero = F.lit(0).cast("long")
    # First run: the bytes and the leaf that each conversation counts, and the bytes above its first node.
    first = trie_nodes(chunks.withColumns({"gain": zero, "leaf": zero}))
    counted = first.groupBy("conv_id").agg(
        F.sum("size").alias("own"), F.min("before").alias("above"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf")
    )
    whole = chunks.groupBy("conv_id").agg(F.sum("bytes").alias("bytes"), F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"))
    per_conv = plan.join(whole, "conv_id", "left").join(counted, "conv_id", "left")
    per_conv = materialize(
        per_conv.select(
            "conv_id", F.col("length").alias("depth"), F.coalesce("k1", zero).alias("k1"), F.coalesce("k2", zero).alias("k2"), "above",
            (F.coalesce("bytes", zero) - F.coalesce("own", zero)).alias("gain"), F.coalesce("leaf", zero).alias("leaf"),
        )
    )
    # Second run: their sums over the members of each node.
    nodes = trie_nodes(chunks.join(per_conv.select("conv_id", "gain", "leaf"), "conv_id")).join(per_conv.select("conv_id", "above"), "conv_id")
    saved = F.col("gain") - F.col("n") * F.col("before") + F.col("before") - F.col("above")
    nodes = nodes.select(*_KEY, "p1", "p2", "conv_id", "n", "leaf", saved.alias("saved"))
    root = per_conv.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.greatest(F.sum("leaf"), F.lit(1)).alias("leaf"), F.sum("gain").alias("saved")
    ).where("n > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n", "leaf", "saved")
    nodes = materialize(nodes.unionByName(root))
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = (
        nodes.join(below.agg(F.count(F.lit(1)).alias("children")), list(_KEY), "left")
        .join(ends_hashes(per_conv), list(_KEY), "left")
        .join(parents, ["depth", "p1", "p2"], "left")
    )
    return found.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("children", zero).alias("n_children"),
        F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


#: CRC-32 bit by bit; a node is the joined hashes of its turns.
ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS own, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda x, b: list_reduce(list_prepend(xor(x, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295) % 9 AS h
  FROM t GROUP BY conv_id),
plan AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.own, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (
  SELECT plan.conv_id, pos AS d, role, text FROM plan JOIN t ON t.conv_id = base AND pos <= h
  UNION ALL SELECT conv_id, pos - h + taken, role, text FROM plan JOIN t USING (conv_id) WHERE pos > h),
paths AS (
  SELECT conv_id, d, strlen(text) AS size, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
lengths AS (SELECT conv_id, max(d) AS length FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = d), '') AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY path),
kids AS (SELECT substr(path, 1, 32 * (depth - 1)::INT) AS path, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(children, 0) AS children FROM nodes LEFT JOIN kids USING (path)),
above AS (SELECT unnest(range(depth + 1)) AS up, * FROM full_nodes),
subtree AS (
  SELECT substr(path, 1, 32 * up::INT) AS path, count_if(children = 0) AS leaves, sum((n - 1) * size) AS saved FROM above GROUP BY 1)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, x.children AS n_children, leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM full_nodes x JOIN subtree USING (path) LEFT JOIN nodes p ON x.depth > 0 AND p.path = substr(x.path, 1, 32 * (x.depth - 1)::INT)
"""
