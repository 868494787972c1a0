"""Exact near-duplicate vectors by dual traversal of cover trees.

Vectors of one label and dimension are compared by cosine in double precision; a pair at or above the threshold is a link.  On
unit vectors that is a distance bound, so the triangle inequality applies.

1. Equal vectors of a label form a class; classes are the points of the trees.
2. Upper levels, as Spark jobs: a node with more points than a block may hold gets pivots (spread-out points of a bounded
   seeded sample) and hands each point to its nearest one, until every node is a block.  A node keeps its center and its
   covering radius; points that have come into a block are not moved again.
3. Dual traversal of the upper levels: a pair of nodes of one label is dropped when their centers are farther apart than both
   radii and the bound together, else replaced by the pairs of their children.
4. Each pair of blocks that is left is one group of at most two blocks.  There each block becomes a cover tree with nested
   levels of radii 1, 1/2, 1/4, 1/8; a level takes out the balls that hold `LEAST` points or more, and what is scattered
   between them stays together as one leaf.  Pairs of nodes are pruned by their covering radii, and pairs that lie within the
   bound as a whole are counted without a look at their points.
5. Pairs of leaves are matrix products.  The leading coordinates in an orthonormal basis and the length of the rest bound a
   cosine from above (Cauchy-Schwarz); where the bound, in single precision and loosened by its rounding, reaches the
   threshold, the cosine itself is taken in double precision.  A sample only says how many coordinates cost least.
6. A group returns sums of links for each point and star links to one point of each connected part, so a dense group of n
   copies costs n rows, not n * n.  Sums and components are put together over all groups.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with
nothing: n_links 0, component_id their own vec_id.  Vectors of different dimension do not link.  Rows that repeat a vec_id are
vectors of their own and link as such; a component is named by its smallest vec_id.  An empty table gives an empty result.

Scale: a group's memory is bounded by the size of a block, whatever the label's share of the rows: `BLOCK` points, fewer of
long vectors.  Points that no pivot can tell apart are dealt out by hash.  In high dimensions without clusters few upper pairs
can be pruned and the work grows with the square of a label's rows, as for any exact method, at about two nanoseconds a pair
of 64 dimensions; the shuffle then carries each block once for each block it meets, in the precision of the input column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from care_episodes.llm.buffers import utf8
from care_episodes.llm.columns import packed, unpacked
from care_episodes.llm.components import components
from care_episodes.session import materialize

THRESHOLD = 0.93
BLOCK, PIVOTS, PER_PIVOT = 65536, 16, 8
#: Long vectors: a block holds so many numbers at most, or so many points if that is more.
BLOCK_NUMBERS, BLOCK_LONG = 1 << 22, 4000
RADII = (1.0, 0.5, 0.25, 0.125)
#: A ball of fewer points is no node of its own; so many centers are tried at a time, and so many node pairs are looked at.
LEAST, TRIES, NODE_PAIRS = 64, 64, 1 << 14
#: Points of a tile of leaf pairs, and the share of its pairs from which on all its cosines are taken.
TILE, TILE_WIDE, DENSE = 256, 2048, 0.02
#: Coordinates tried for the bound, and points of each side that choose among them.
LEADING, CHOOSING = (8, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512), 256
#: Pairs of points that are worth a task and those that take as long as a group's start; tasks at most.
TASK_PAIRS, GROUP_PAIRS, MOST_TASKS = 1 << 24, 400_000, 2000
#: Rounding of distances; pruning is looser and inclusion tighter by this.
SLACK = 1e-6


def bound(threshold: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class CoverTree:
    """Nested nets of unit vectors; node 0 is the root, and node k holds the points order[first[k]:last[k]].

    The children of a node follow each other and share out its points; the last of them may be what no ball has taken.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        center, radius, first, last, child, children = [], [], [], [], [], []

        def node(at: int, lo: int, hi: int) -> int:
            low = float((points[self.order[lo:hi]] @ points[at]).min())
            for column, value in ((center, at), (radius, np.sqrt(max(2 - 2 * low, 0.0))), (first, lo), (last, hi), (child, 0), (children, 0)):
                column.append(value)
            return len(center) - 1

        stack = [(node(0, 0, len(points)), 0)] if len(points) else []
        while stack:
            parent, level = stack.pop()
            lo, hi = first[parent], last[parent]
            # Levels at which one ball would hold the whole node say nothing new.
            while level < len(RADII) and radius[parent] <= RADII[level]:
                level += 1
            if level == len(RADII) or hi - lo < 2 * LEAST:
                continue
            balls, rest = self._net(self.order[lo:hi], RADII[level])
            if not balls:
                continue
            child[parent], children[parent] = len(center), len(balls) + bool(len(rest))
            for at, ball in [*balls, *[(center[parent], rest)] * bool(len(rest))]:
                self.order[lo : lo + len(ball)] = ball
                made = node(at, lo, lo + len(ball))
                lo += len(ball)
                if ball is not rest:
                    stack.append((made, level + 1))
        self.center, self.radius = np.array(center, np.int64), np.array(radius)
        self.first, self.last, self.child, self.children = (np.array(x, np.int64) for x in (first, last, child, children))

    def _net(self, rest: np.ndarray, radius: float) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
        """(center, points) of balls, and the points left when a turn of centers found few balls."""
        balls, found = [], TRIES * LEAST
        while len(rest) >= LEAST and found >= TRIES * LEAST:
            tries = rest[:TRIES]
            near = self.points[tries] @ self.points[rest].T >= 1 - radius * radius / 2
            free = np.ones(len(rest), bool)
            for k, at in enumerate(tries.tolist()):
                if free[k] and (ball := near[k] & free).sum() >= LEAST:
                    balls.append((at, rest[ball]))
                    free &= ~ball
            found = len(rest) - int(free.sum())
            rest = np.concatenate([rest[TRIES:][free[TRIES:]], tries[free[:TRIES]]])
        return balls, rest


class Links:
    """Sums of links for each point of both sides, and which points hang together."""

    def __init__(self, copies: np.ndarray):
        self.copies = copies
        self.sums = np.zeros(len(copies), np.int64)
        self.parent = np.arange(len(copies))  # of each point its root
        self.waiting, self.n_waiting = [], 0

    def roots(self) -> np.ndarray:
        """The smallest point that hangs together with each point."""
        if self.waiting:
            u, v = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
            self.waiting, self.n_waiting = [], 0
            while True:
                new = self.parent[u] != self.parent[v]
                if not new.any():
                    break
                u, v = u[new], v[new]
                a, b = self.parent[u], self.parent[v]
                np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
                while (self.parent != (up := self.parent[self.parent])).any():
                    self.parent = up
        return self.parent

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        self.waiting.append((x, y))
        self.n_waiting += len(x)
        if self.n_waiting > 1 << 20 or len(self.waiting) > 1 << 12:
            self.roots()

    def all_between(self, x: np.ndarray, y: np.ndarray) -> None:
        self.sums[x] += self.copies[y].sum()
        self.sums[y] += self.copies[x].sum()
        self.join(x, np.full(len(x), y[0]))
        self.join(y, np.full(len(y), x[0]))

    def all_within(self, x: np.ndarray) -> None:
        self.sums[x] += self.copies[x].sum() - self.copies[x]
        self.join(x, np.full(len(x), x[0]))

    def pairs(self, x: np.ndarray, y: np.ndarray) -> None:
        np.add.at(self.sums, x, self.copies[y])
        np.add.at(self.sums, y, self.copies[x])
        self.join(x, y)

    def matrix(self, x: np.ndarray, y: np.ndarray, hit: np.ndarray) -> None:
        """Links of hit[i, j] between x[i] and y[j]; many of them, so a look at each one comes last."""
        many = hit.astype(np.float64)
        # x and y may share points, but neither repeats one.
        self.sums[x] += np.rint(many @ self.copies[y]).astype(np.int64)
        self.sums[y] += np.rint(self.copies[x] @ many).astype(np.int64)
        rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        self.join(x[rows], y[hit[rows].argmax(axis=1)])
        self.join(x[hit[:, columns].argmax(axis=0)], y[columns])
        root = self.roots()
        u, v = np.nonzero(hit & (root[x][:, None] != root[y][None]))
        self.join(x[u], y[v])


class Bound:
    """Bounds from above for cosines of unit vectors: (a @ b.T) >= `low` wherever a cosine reaches the threshold."""

    def __init__(self, unit: np.ndarray, left: int, threshold: float):
        dims, half = unit.shape[1], left if left < len(unit) else left // 2
        leading, basis = dims, None
        if dims > LEADING[0] and min(half, len(unit) - half) >= 2 * CHOOSING:
            turned = np.linalg.svd(np.concatenate([unit[:CHOOSING], unit[half : half + CHOOSING]]), full_matrices=False)[2]
            # Other points than those that the basis fits.
            x, y = (unit[k + CHOOSING : k + 2 * CHOOSING] @ turned.T for k in (0, half))
            each = 300 + 2 * dims  # nanoseconds for the cosine of a pair that the bound keeps

            def cost(n: int) -> float:
                rest = [np.sqrt(np.maximum(1 - (z[:, :n] ** 2).sum(axis=1), 0)) for z in (x, y)]
                kept = float((x[:, :n] @ y[:, :n].T + rest[0][:, None] * rest[1][None] >= threshold).mean()) if n < dims else 0.0
                return 0.05 * (n + 1) + kept * each

            leading = min([n for n in LEADING if n < min(dims, len(turned))] + [dims], key=cost)
            basis = turned[:leading]
        if leading < dims:
            first = unit @ basis.T
            rest = np.sqrt(np.maximum(1 - (first * first).sum(axis=1, keepdims=True), 0) + 1e-14)
            unit = np.concatenate([first, rest], axis=1)
        self.vectors = unit.astype(np.float32)
        self.low = np.float32(threshold - (self.vectors.shape[1] + 8) * 2.0**-22)


class Leaves:
    """Compares the points of leaves."""

    def __init__(self, raw: np.ndarray, left: int, links: Links, threshold: float):
        self.raw, self.links, self.threshold = raw, links, threshold
        self.length = np.sqrt((raw * raw).sum(axis=1))
        self.bound = Bound(raw / self.length[:, None], left, threshold)
        self.product, self.kept = np.empty(TILE * TILE_WIDE, np.float32), np.empty(TILE * TILE_WIDE + 8, bool)

    def compare(self, p: np.ndarray, q: np.ndarray, own: bool) -> None:
        """Links all pairs between p and q, or those within p, if q is p (own)."""
        wide, high = self.bound.vectors[q], self.bound.vectors[p]
        for start in range(0, len(p), TILE):
            for other in range(start if own else 0, len(q), TILE_WIDE):
                x, y = p[start : start + TILE], q[other : other + TILE_WIDE]
                size = len(x) * len(y)
                product = self.product[:size].reshape(len(x), len(y))
                np.matmul(high[start : start + TILE], wide[other : other + TILE_WIDE].T, out=product)
                np.greater_equal(product, self.bound.low, out=self.kept[:size].reshape(len(x), len(y)))
                self.kept[size : size + 8] = False
                # Eight at a time, as few are kept.
                eight = np.flatnonzero(self.kept[: -(-size // 8) * 8].view(np.uint64))
                kept = (eight[:, None] * 8 + np.arange(8)).ravel()
                u, v = np.divmod(kept[self.kept[kept]], len(y))
                if len(u) > DENSE * size:
                    hit = (self.raw[x] @ self.raw[y].T) / (self.length[x][:, None] * self.length[y][None]) >= self.threshold
                    if own:
                        hit &= start + np.arange(len(x))[:, None] < other + np.arange(len(y))[None]
                    self.links.matrix(x, y, hit)
                    continue
                if own:
                    once = start + u < other + v
                    u, v = u[once], v[once]
                if len(u):
                    x, y = x[u], y[v]
                    hit = np.einsum("ij,ij->i", self.raw[x], self.raw[y]) / (self.length[x] * self.length[y]) >= self.threshold
                    self.links.pairs(x[hit], y[hit])


def _children(a: CoverTree, b: CoverTree, x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of nodes replaced by the pairs of their children; a leaf stands for itself."""
    (fa, na), (fb, nb) = ((np.where(t.children[k] > 0, t.child[k], k), np.maximum(t.children[k], 1)) for t, k in ((a, x), (b, y)))
    of = np.repeat(np.arange(len(x)), na * nb)
    k = np.arange(len(of)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
    left, right = fa[of] + k // nb[of], fb[of] + k % nb[of]
    once = ~((x == y)[of] & (left > right)) if same else slice(None)
    return left[once], right[once]


def traverse(a: CoverTree, b: CoverTree, shift: int, raw: np.ndarray, links: Links, threshold: float) -> None:
    """Links all pairs between two trees (or within one, if b is a); raw holds the vectors as given, b's from `shift` on."""
    if not len(a.order) or not len(b.order):
        return
    near, same = bound(threshold), a is b
    add = 0 if same else shift
    points = [lambda k: a.order[a.first[k] : a.last[k]], lambda k: b.order[b.first[k] : b.last[k]] + add]
    ends = []
    stack = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        x, y = stack.pop()
        if len(x) > NODE_PAIRS:
            stack += [(x[NODE_PAIRS:], y[NODE_PAIRS:])]
            x, y = x[:NODE_PAIRS], y[:NODE_PAIRS]
        away = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", a.points[a.center[x]], b.points[b.center[y]]), 0))
        reach = a.radius[x] + b.radius[y]
        keep = away <= reach + near + SLACK
        whole = away + reach <= near - SLACK
        for i, j in zip(x[whole].tolist(), y[whole].tolist(), strict=True):
            if same and i == j:
                links.all_within(points[0](i))
            else:
                links.all_between(points[0](i), points[1](j))
        x, y = x[keep & ~whole], y[keep & ~whole]
        end = (a.children[x] == 0) & (b.children[y] == 0)
        ends.append((x[end], y[end]))
        if not end.all():
            stack.append(_children(a, b, x[~end], y[~end], same))
    x, y = (np.concatenate(k) for k in zip(*ends, strict=True))
    if not len(x):
        return
    leaves = Leaves(raw, len(a.points), links, threshold)
    by = np.lexsort((y, x))
    x, y = x[by], y[by]
    starts = np.flatnonzero(np.diff(x, prepend=-1))
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(x)], strict=True):
        p, others = points[0](int(x[lo])), [int(k) for k in y[lo:hi] if not (same and k == x[lo])]
        if len(others) < hi - lo:
            leaves.compare(p, p, True)
        if others:
            leaves.compare(p, np.concatenate([points[1](k) for k in others]), False)


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    """The vectors of a binary column, all of one dimension, in double precision."""
    data, offsets = utf8(column)
    return np.frombuffer(data.tobytes(), kind).reshape(len(offsets) - 1, -1).astype(np.float64)


def _join_blocks(threshold: float, kind: str):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("side", "ascending"), ("cls", "ascending")]).combine_chunks()
        raw = _vectors(rows["vector"].chunk(0), kind)
        unit = _unit(raw)
        left = int((rows["side"].to_numpy() == 0).sum())
        links = Links(rows["copies"].to_numpy().astype(np.int64))
        first = CoverTree(unit[:left])
        traverse(first, first if left == len(raw) else CoverTree(unit[left:]), left if left < len(raw) else 0, raw, links, threshold)
        hit = np.flatnonzero(links.sums > 0)
        return pa.table({"cls": rows["cls"].take(hit), "other": rows["cls"].take(links.roots()[hit]), "links": links.sums[hit]})

    return run


def _points(kind: str):
    """Names each usable vector by its label, dimension and values; the values are handed on in the precision `kind`."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4000):
                part = batch.slice(start, 4000)
                lists, labels = part.column(1), part.column(2).to_pylist()
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                numbers = pc.cast(lists.flatten(), pa.float64(), safe=False).to_numpy(zero_copy_only=False)  # null: NaN
                begin = np.cumsum(sizes) - sizes
                named = np.array([x is not None for x in labels], bool)
                names, vectors, groups = ([None] * part.num_rows for _ in range(3))
                for size in np.unique(sizes[named & (sizes > 0)]).tolist():
                    at = np.flatnonzero(named & (sizes == size))
                    values = numbers[begin[at][:, None] + np.arange(size)]
                    largest = np.abs(values).max(axis=1)
                    usable = np.isfinite(largest) & (largest > 0)
                    # Scaled by a power of two, which changes no cosine, so that no square over- or underflows; -0.0 equals 0.0.
                    values = np.ldexp(values[usable], -np.frexp(largest[usable])[1][:, None]) + 0.0
                    # In single precision only what is lost in any double sum beside the largest number may go.
                    short = values.astype(kind)
                    for k, value, vector in zip(at[usable].tolist(), values, short, strict=True):
                        groups[k] = f"{labels[k]}/{size}"
                        names[k] = hashlib.blake2b(groups[k].encode() + value.tobytes(), digest_size=16).digest()
                        vectors[k] = vector.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.binary()), pa.array(groups, pa.string()), pa.array(vectors, pa.binary())],
                    names=["vec_id", "cls", "grp", "vector"],
                )

    return run


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _pivots(kind: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Spread-out points of a node's sample: the farthest from those chosen so far."""
        rows = rows.sort_values("cls")
        points = _unit(np.stack([np.frombuffer(v, kind) for v in rows["vector"]]).astype(np.float64))
        chosen = [0]
        near = distances(points, points[:1])[:, 0]
        while len(chosen) < min(int(rows["wanted"].iloc[0]), len(points)) and near.max() > SLACK:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, distances(points, points[chosen[-1] : chosen[-1] + 1])[:, 0])
        return pd.DataFrame({"node": [rows["node"].iloc[0]], "pivots": [points[chosen].tobytes()], "n": [len(chosen)], "parts": [int(rows["wanted"].iloc[0])]})

    return run


def _assign(kind: str):
    """Hands each point to the nearest pivot of its node; points of a node with one pivot are dealt out by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, cls = batch.column("node").dictionary_encode(), batch.column("cls")
            codes = nodes.indices.to_numpy()
            child, pivot, away = np.empty(len(codes), object), np.empty(len(codes), np.int32), np.empty(len(codes))
            for code, node in enumerate(nodes.dictionary.to_pylist()):
                at = np.flatnonzero(codes == code)
                given = {c: batch.column(c)[int(at[0])].as_py() for c in ("pivots", "n", "parts")}
                far = distances(_unit(_vectors(batch.column("vector").take(pa.array(at)), kind)), np.frombuffer(given["pivots"], np.float64).reshape(given["n"], -1))
                pivot[at] = own = far.argmin(axis=1)
                away[at] = far[np.arange(len(own)), own]
                name = own if given["n"] > 1 else [int.from_bytes(cls[k].as_py()[:4], "little") % given["parts"] for k in at.tolist()]
                child[at] = [f"{node}.{k}" for k in name]
            yield pa.RecordBatch.from_arrays(
                [cls, batch.column("copies"), batch.column("vector"), batch.column("node"), pa.array(child, pa.string()), pa.array(pivot), pa.array(away)],
                names=["cls", "copies", "vector", "node", "child", "pivot", "away"],
            )

    return run


def _pruned(near: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([None if v is None else np.frombuffer(v, np.float64) for v in batch.column(k).to_pylist()] for k in (2, 3))
            reach = np.asarray(batch.column(4)) + near + SLACK
            keep = [x is None or y is None or float(distances(x[None], y[None])[0, 0]) <= r for x, y, r in zip(a, b, reach, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def blocks(points: DataFrame, kind: str) -> tuple[DataFrame, list[DataFrame]]:
    """(cls, copies, vector, node) in blocks, and the nodes of each level, from the roots on: (node, child, center, radius)."""
    points = points.select("cls", "copies", "vector", F.col("grp").alias("node"))
    done, levels = None, [materialize(points.select("node", F.col("node").alias("child"), F.lit(None).cast("binary").alias("center"), F.lit(0.0).alias("radius")).distinct())]
    while True:
        # A root is named label/dimension, a child by its parent and a number.
        dims = F.split_part(F.substring_index("node", "/", -1), F.lit("."), F.lit(1)).cast("int")
        most = F.least(F.lit(BLOCK), F.greatest(F.lit(BLOCK_LONG), F.floor(F.lit(BLOCK_NUMBERS) / dims)))
        large = materialize(points.groupBy("node").count().withColumn("most", most).where("count > most"))
        here = points.join(large.select("node"), "node", "left_anti")
        done = here if done is None else done.unionByName(here)
        if large.isEmpty():
            return done, levels
        # Few blocks, as each is sent once for each that it meets.
        wanted = F.least(F.lit(PIVOTS), F.ceil(F.col("count") * 4 / (F.col("most") * 3))).cast("int")
        share = F.lit(float(PIVOTS * PER_PIVOT)) / F.col("count") * float(1 << 31)
        place = F.pmod(F.xxhash64("cls", F.lit(len(levels) - 1)), F.lit(1 << 31))
        sample = points.join(large.withColumn("wanted", wanted), "node").where(place < share).select("node", "cls", "vector", "wanted")
        pivots = materialize(sample.groupBy("node").applyInPandas(_pivots(kind), "node string, pivots binary, n int, parts int"))
        moved = materialize(
            points.join(pivots, "node").select("cls", "copies", "vector", "node", "pivots", "n", "parts").mapInArrow(
                _assign(kind), "cls binary, copies long, vector binary, node string, child string, pivot int, away double"
            )
        )
        width = F.floor(F.length("pivots") / F.col("n")).cast("int")
        new = moved.groupBy("node", "child", "pivot").agg(F.max("away").alias("radius")).join(pivots, "node").select(
            "node", "child", F.col("pivots").substr(F.col("pivot") * width + 1, width).alias("center"), "radius"
        )
        # Blocks stand for themselves from now on.
        kept = levels[-1].join(large.select(F.col("node").alias("child")), "child", "left_anti").select(F.col("child").alias("node"), "child", "center", "radius")
        levels.append(materialize(new.union(kept)))
        points = moved.select("cls", "copies", "vector", F.col("child").alias("node"))


def block_pairs(levels: list[DataFrame], near: float) -> DataFrame:
    """(a, b) of blocks that may hold links, a <= b, by dual traversal of the upper levels."""
    pairs = levels[0].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in levels[1:]:
        # Dealt-out points of one center are several children with the same center.
        down = [level.select(*[F.col(c).alias(f"{c}_{s}") for c in level.columns]) for s in ("a", "b")]
        wide = pairs.join(down[0], F.col("a") == F.col("node_a")).join(down[1], F.col("b") == F.col("node_b"))
        wide = wide.where("child_a <= child_b or a <> b").select(
            F.least("child_a", "child_b").alias("a"), F.greatest("child_a", "child_b").alias("b"), "center_a", "center_b", (F.col("radius_a") + F.col("radius_b")).alias("reach")
        )
        pairs = materialize(wide.mapInArrow(_pruned(near), "a string, b string").distinct())
    return pairs


def _tasks(held: DataFrame, pairs: DataFrame) -> int:
    """Tasks for the groups, by what they have to do: a group is little to read."""
    sizes = held.groupBy("node").agg(F.count("*").cast("double").alias("n"))
    wide = pairs.join(sizes.withColumnsRenamed({"node": "a", "n": "n_a"}), "a").join(sizes.withColumnsRenamed({"node": "b", "n": "n_b"}), "b")
    groups, work = wide.agg(F.count("*"), F.sum(F.col("n_a") * F.col("n_b") + GROUP_PAIRS)).first()
    return max(1, min(int((work or 0) / TASK_PAIRS), 2 * groups, MOST_TASKS))


def linked(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    ids = vectors.schema["vec_id"].dataType.simpleString()
    kind = "f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "f8"
    rows = materialize(
        vectors.select("vec_id", "embedding", "label").mapInArrow(_points(kind), f"vec_id {ids}, cls binary, grp string, vector binary")
    )
    classes = materialize(
        rows.where("cls is not null").groupBy("cls").agg(F.any_value("grp").alias("grp"), F.any_value("vector").alias("vector"), F.count("*").alias("copies"))
    )
    held, levels = blocks(classes, kind)
    pairs = block_pairs(levels, bound(threshold))
    left = pairs.join(held, F.col("a") == F.col("node")).withColumn("side", F.lit(0))
    right = pairs.where("a <> b").join(held, F.col("b") == F.col("node")).withColumn("side", F.lit(1))
    both = left.unionByName(right).select("a", "b", "side", "cls", "copies", "vector")
    found = materialize(both.repartition(_tasks(held, pairs), "a", "b").groupBy("a", "b").applyInArrow(_join_blocks(threshold, kind), "cls binary, other binary, links long"))
    sums = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    named = (
        rows.drop("vector", "grp")
        .join(classes.select("cls", "copies").join(sums, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left"), "cls", "left")
        .withColumn("part", F.coalesce("root", "cls"))
    )
    least = named.where("part is not null").groupBy("part").agg(F.min("vec_id").alias("least"))
    return named.join(least, "part", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("least", "vec_id")).alias("kept"),
    )


def without_near_copies(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that name their component; rows that repeat a vec_id stay together."""
    gone = linked(vectors, threshold).where("not kept").select(F.col("vec_id").alias("gone")).distinct()
    return unpacked(packed(vectors, id=F.col("vec_id")).join(gone, F.col("id") == F.col("gone"), "left_anti"))


#: All pairs of a label; for small tables.
ORACLE = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS size FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
good AS (SELECT * FROM e WHERE size > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
parts AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, p.component_id, e.vec_id = p.component_id AS kept
FROM embeddings e JOIN parts p ON p.node = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""
