import re

import numpy as np
import pytest

from care_episodes.llm import cover_tree, lsh_forest
from tests.llm.helpers import ascii_lower, components, corpus, docs_of, rows

SPACE = r"[^\x20\x09-\x0D]+"


def shingles(text):
    words = re.findall(SPACE, ascii_lower(text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_match_all_pairs(spark, seed):
    texts = corpus(seed, 80)
    sets = [shingles(t) for t in texts]
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    want = components(range(len(sets)), links)
    got = rows(lsh_forest.deduplicate(docs_of(spark, texts, extra=True)))
    assert len(got) == len(texts)
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == want[r["doc_id"]]
        assert r["kept"] == (r["component_id"] == r["doc_id"])
    assert len(links) > 10


def test_documents_repeated_rows_null_ids_and_columns(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(5, text, 1), (5, text, 1), (3, text, 2), (None, text, 3), (7, "alone here", 4)], "doc_id long, text string, row int")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in rows(lsh_forest.deduplicate(df))), key=str)
    assert got == sorted([(3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True), (None, 3, False)], key=str)
    kept = lsh_forest.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in rows(kept)) == [3, 7]


def test_documents_with_null_ids_only(spark):
    words = [f"w{k}" for k in range(60)]
    near = [*words[:-1], "other"]
    df = spark.createDataFrame([(None, " ".join(words)), (None, " ".join(near)), (None, "nothing like it"), (4, "alone")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows(lsh_forest.deduplicate(df))), key=str)
    assert got == sorted([(None, 56, None, True), (None, 56, None, True), (None, 1, None, True), (4, 1, 4, True)], key=str)
    assert len(rows(lsh_forest.keep_first(df))) == 4


def test_growing_tables_are_merged_and_sets_stay_where_they_are_made(spark, monkeypatch):
    plans, store = [], lsh_forest.materialize

    def stored(df):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return store(df)

    monkeypatch.setattr(lsh_forest, "materialize", stored)
    texts = corpus(2, 80)
    found = lsh_forest.deduplicate(docs_of(spark, texts))
    plans.append((found.columns, found._jdf.queryExecution().executedPlan().toString()))
    assert not [c for c, plan in plans if "BroadcastHashJoin" in plan]
    (of_sets,) = [plan for c, plan in plans if c == ["set_id", "shingles"]]
    assert of_sets.index("MapInArrow") < of_sets.index("Exchange")


def test_finer_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    for share in (0.6, 0.75, 0.9):
        both = int(400 * share)
        x = np.unique(pool[:400])
        y = np.unique(np.concatenate([pool[:both], pool[400 : 800 - both]]))
        exact = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        a, b = lsh_forest.fine_sketches([x, y])
        finer = 1 - 2 * np.bitwise_count(a ^ b).sum() / lsh_forest.FINE
        assert abs(finer - exact) < 0.08


def test_documents_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rows(lsh_forest.deduplicate(df)) == []


def test_hot_group_of_near_copies(spark):
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(300):
        words = list(base)
        words[(k * 7) % 120] = f"edit{k}"
        texts.append(" ".join(words))
    got = rows(lsh_forest.deduplicate(docs_of(spark, texts)))
    assert {r["component_id"] for r in got} == {0}


def test_links_hidden_in_a_thick_region(spark):
    """2,400 documents that share a long text (similarity 0.73 to each other), 12 pairs of them share a little more."""
    shared = [f"s{k}" for k in range(172)]
    texts = [" ".join([*(f"p{k // 2}x{j}" if k < 24 else f"d{k}x{j}" for j in range(6)), *shared, *(f"u{k}x{j}" for j in range(26))]) for k in range(2400)]
    sets = [shingles(t) for t in texts[:26]]
    linked = [(i, j) for j in range(26) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert linked == [(2 * k, 2 * k + 1) for k in range(12)]
    got = {r["doc_id"]: r["component_id"] for r in rows(lsh_forest.deduplicate(docs_of(spark, texts)))}
    assert got == {k: k - k % 2 if k < 24 else k for k in range(2400)}


def test_true_link_behind_better_estimates(spark):
    """A text is linked with its first three quarters (0.75); a part just too short (0.747), linked with those, looks nearer by the minhashes."""
    texts = []
    for k in (24, 118, 270, 397):
        words = [f"{k}w{j}" for j in range(304)]
        texts += [" ".join(words), " ".join(words[:229]), " ".join(words[22:250])]
    got = {r["doc_id"]: r["component_id"] for r in rows(lsh_forest.deduplicate(docs_of(spark, texts)))}
    assert got == {k: k - k % 3 for k in range(len(texts))}


def vectors(seed, n, dims=16):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        kind = rng.random()
        if out and kind < 0.4:
            base = np.array(out[rng.integers(len(out))][1])
            out.append((k, (base + rng.normal(size=dims) * rng.choice([0, 0.05, 0.1, 0.12])).tolist(), int(rng.integers(3))))
        else:
            out.append((k, (rng.normal(size=dims) * rng.choice([1, 1e-3, 50])).tolist(), int(rng.integers(3))))
    return out


def expected_links(data, threshold=0.93):
    good = [(i, np.array(v), label) for i, v, label in data if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = []
    for a in range(len(good)):
        for b in range(a):
            (i, x, p), (j, y, q) = good[a], good[b]
            if p == q and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links.append((i, j))
    return links


@pytest.mark.parametrize("block", [4000, 25])
def test_vectors_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    data = vectors(3, 250)
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [1.0, None], 1), (1004, data[0][1], None), (1005, [], 1), (1006, [1.0, 0.0], 1), (1007, [float("inf")] * 16, 0)]
    data += odd
    links = expected_links(data)
    want, degree = components([d[0] for d in data], links), {d[0]: 0 for d in data}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS node", "'x' AS cls", "2 AS row")
    got = rows(cover_tree.linked(df))
    assert len(got) == len(data) and len(links) > 20
    for r in got:
        assert (r["n_links"], r["component_id"]) == (degree[r["vec_id"]], want[r["vec_id"]])
        assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_vectors_many_equal_points_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 20)
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    data = [(k, (base + rng.normal(size=8) * 1e-9).tolist(), 0) for k in range(120)]
    got = rows(cover_tree.linked(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")))
    assert {(r["n_links"], r["component_id"]) for r in got} == {(119, 0)}


def test_vectors_empty_table_and_repeated_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert rows(cover_tree.linked(spark.createDataFrame([], schema))) == []
    got = rows(cover_tree.linked(spark.createDataFrame([(4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)], schema)))
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(2, 0, 2), (4, 1, 4), (4, 1, 4)]


def test_tree_traversal_prunes_nothing_it_needs():
    rng = np.random.default_rng(0)
    raw = np.concatenate([rng.normal(size=(60, 6)), np.repeat(rng.normal(size=(3, 6)), 20, axis=0) + rng.normal(size=(60, 6)) * 0.03])
    unit = raw / np.linalg.norm(raw, axis=1)[:, None]
    links = cover_tree.Links(np.ones(len(raw), np.int64))
    left, right = cover_tree.CoverTree(unit[:70]), cover_tree.CoverTree(unit[70:])
    cover_tree.traverse(left, right, 70, raw, links, 0.9)
    near = unit[:70] @ unit[70:].T >= 0.9
    assert (links.sums[:70] == near.sum(axis=1)).all() and (links.sums[70:] == near.sum(axis=0)).all()


def linked_by_hand(unit, left, threshold):
    """Number of links and smallest point of the component, for all pairs between both sides (or within one)."""
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    if left < len(unit):
        near[:left, :left] = near[left:, left:] = False
    names = components(range(len(unit)), list(zip(*np.nonzero(near), strict=True)))
    return near.sum(axis=1), [names[k] for k in range(len(unit))]


@pytest.mark.parametrize("dims, noise, tries", [(64, 0.02, 64), (64, 0.2, 64), (64, 0.55, 64), (3, 0.3, 64), (100, 0.05, 2), (16, 0.3, 1)])
def test_tree_with_balls_and_scattered_points(monkeypatch, dims, noise, tries):
    monkeypatch.setattr(cover_tree, "TRIES", tries)
    rng = np.random.default_rng(dims)
    for sizes in ((700, 500), (700, 0), (65, 64), (1, 1)):
        centers = rng.normal(size=(4, dims))
        raw = centers[rng.integers(4, size=sum(sizes))] + rng.normal(size=(sum(sizes), dims)) * noise * rng.random((sum(sizes), 1))
        loose = rng.random(len(raw)) < 0.2
        raw[loose] = rng.normal(size=(loose.sum(), dims))
        unit = raw / np.linalg.norm(raw, axis=1)[:, None]
        links = cover_tree.Links(np.ones(len(raw), np.int64))
        first = cover_tree.CoverTree(unit[: sizes[0]])
        cover_tree.traverse(first, cover_tree.CoverTree(unit[sizes[0] :]) if sizes[1] else first, sizes[0] if sizes[1] else 0, raw, links, 0.93)
        degree, names = linked_by_hand(unit, sizes[0], 0.93)
        assert (links.sums == degree).all() and links.roots().tolist() == names


def test_tree_ball_and_one_point_beside_it():
    """The scattered rest is a node of its own, though it be one point; its radius reaches from the parent's center to it."""
    rng = np.random.default_rng(2)
    ball = rng.normal(size=64) + rng.normal(size=(200, 64)) * 0.01
    raw = np.concatenate([ball, rng.normal(size=(1, 64)), ball[:100] + rng.normal(size=(100, 64)) * 0.01, rng.normal(size=(1, 64))])
    unit = raw / np.linalg.norm(raw, axis=1)[:, None]
    links = cover_tree.Links(np.ones(len(raw), np.int64))
    left, right = cover_tree.CoverTree(unit[:201]), cover_tree.CoverTree(unit[201:])
    assert left.children[0] == 2 and sorted(left.order.tolist()) == list(range(201))
    cover_tree.traverse(left, right, 201, raw, links, 0.93)
    assert links.sums.tolist() == [100] * 200 + [0] + [200] * 100 + [0]


def test_tree_scattered_points_take_nanoseconds_a_pair():
    """18 million pairs of 64 dimensions: below 5 s of CPU (0.1 expected); a net with a node for each point took 21 s."""
    import time

    rng = np.random.default_rng(4)
    raw = rng.normal(size=(6000, 64))
    raw[5999] = raw[0] * 3
    links = cover_tree.Links(np.ones(len(raw), np.int64))
    began = time.thread_time()
    tree = cover_tree.CoverTree(raw / np.linalg.norm(raw, axis=1)[:, None])
    cover_tree.traverse(tree, tree, 0, raw, links, 0.93)
    assert time.thread_time() - began < 5
    assert np.flatnonzero(links.sums).tolist() == [0, 5999]


def test_vectors_of_single_precision_and_labels_with_dots(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 30)
    data = [(k, np.array(v, np.float32).tolist(), f"a.b/{label}.5") for k, v, label in vectors(8, 200)]
    links = expected_links(data)
    want = components([d[0] for d in data], links)
    got = {r["vec_id"]: r for r in rows(cover_tree.linked(spark.createDataFrame(data, "vec_id long, embedding array<float>, label string")))}
    assert len(links) > 10 and {k: r["component_id"] for k, r in got.items()} == want
    assert sum(r["n_links"] for r in got.values()) == 2 * len(links)
