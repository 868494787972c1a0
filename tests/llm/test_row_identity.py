"""Rows that share an id but not a text; common seeds, short items and text ids in decontamination."""

import random
import time

import numpy as np
import pyarrow as pa

from care_episodes.llm import contamination, line_dedup, mixing
from tests.llm.helpers import prose, rows
from tests.llm.test_models_and_scans import plain_targets


def test_lines_of_different_texts_with_one_id(spark):
    data = [(1, "shared\nfirst own"), (2, "shared\nsecond own"), (2, "totally different opening line\nthird own"), (None, "shared\nx y z"), (None, "p q r\nx y z"), (None, "shared\nx y z")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS version", "'h' AS hash")
    left = sorted((r["doc_id"] or 0, r["text"]) for r in rows(line_dedup.clean(df)))
    # Rows without an id come first; of their texts the one with the smaller md5.
    import hashlib

    order = sorted({t for i, t in data if i is None}, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    seen, want = set(), []
    for i, t in [*((None, t) for t in order), *data[:1], *sorted(data[1:3], key=lambda r: hashlib.md5(r[1].encode()).hexdigest())]:
        kept = [line for line in t.split("\n") if line not in seen]
        seen |= set(t.split("\n"))
        if kept:
            want += [(i or 0, "\n".join(kept))] * data.count((i, t))
    assert left == sorted(want)
    assert ("totally different opening line\nthird own") in {t for _, t in left}


def test_lines_of_many_rows_without_an_id(spark):
    texts = [f"own line {k}\nthe same line in all of them" for k in range(400)]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    got = rows(line_dedup.digest(df))
    assert len(got) == 400 and sum(r["n_removed"] for r in got) == 399


def test_mix_of_rows_without_an_id_comes_near_the_targets(spark):
    data = [(None, f"w{k} " * 8, "a") for k in range(100)] + [(k, "x y " * (k % 7), "b") for k in range(200)] + [(3, f"v{k} " * 5, "c") for k in range(90)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    targets = plain_targets({s: sum(len(t.split()) for _, t, q in data if q == s) for s in "abc"})
    taken = {r["source"]: r["sum(taken)"] for r in rows(mixing.mix(df).groupBy("source").sum("taken"))}
    for s in "abc":
        assert abs(taken[s] - targets[s]) <= 8
    twice = [sorted((r["taken"], r["size"]) for r in rows(mixing.mix_digest(d))) for d in (df, df.repartition(7))]
    assert twice[0] == twice[1]


def aligned(item, text):
    return contamination.smith_waterman([contamination.text_words(pa.array([item]))[0]], [contamination.text_words(pa.array([text]))[0]])[0] / len(item.split())


def test_common_grams_match_alignment_of_all_pairs(spark):
    rng = random.Random(5)
    common = ["of the same", "in the way", "as it is"]
    items, docs = [], []
    for k in range(25):
        items.append(" ".join(rng.choice([*common, f"item{k}w{j}", "the the the"]) for j in range(rng.randrange(4, 12))))
    for k in range(60):
        words = (rng.choice(items) if k % 2 else prose(k, 30)).split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["edit", "the", "same"])
        docs.append(" ".join([*prose(k + 100, 20).split(), *words, *rng.choice(common).split(), *prose(k + 200, 5).split()]))
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows(contamination.leaks(table, benchmark))}
    want = {}
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            score = aligned(item, text)
            if score >= (contamination.LEAST if len(item.split()) >= contamination.SHORT else 1.0) - 1e-6:
                want[d, i] = score
    assert set(want) == set(got) and len(want) > 30
    assert all(abs(want[k] - got[k]) < 1e-9 for k in want)


def test_one_word_over_and_over_is_linear(spark):
    df = spark.createDataFrame([(1, "the " * 60_000), (2, "the " * 2_000 + "end")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "the " * 3_000), (2, "the the the the other")], "item_id long, text string")
    start = time.time()
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows(contamination.leaks(df, benchmark))}
    assert got[1, 1] == 1.0 and abs(got[2, 1] - 2000 / 3000) < 0.01 and (1, 2) not in got
    assert time.time() - start < 120


def test_hits_come_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    item, place = np.repeat(np.arange(40), 5), rng.integers(0, 30, 200)
    seeds = contamination.Seeds(rng.integers(0, 6, 200).astype(np.uint64), item, place)
    k, row = rng.integers(0, len(seeds.values), 90), np.sort(rng.integers(0, 7, 90))
    where = rng.integers(0, 500, 90)

    def all_hits():
        return sorted(x for part in contamination.hits(seeds, k, row, where) for x in zip(*(c.tolist() for c in part)))

    whole = all_hits()
    monkeypatch.setattr(contamination, "HITS", 50)
    assert all_hits() == whole and len(whole) > 1000
    assert max(len(p[0]) for p in contamination.hits(seeds, k, row, where)) < 200


def test_short_items_and_text_ids(spark):
    table = spark.createDataFrame([(1, "say one two now"), (2, "one, TWO"), (3, "two one"), (4, "alpha"), (5, None), (6, "")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("a", "one two"), ("b", "Alpha"), ("c", ""), (None, "two now"), ("d", None)], "item_id string, text string")
    got = {(r["doc_id"], r["item_id"], r["score"]) for r in rows(contamination.leaks(table, benchmark))}
    assert got == {(1, "a", 1.0), (2, "a", 1.0), (4, "b", 1.0), (1, None, 1.0)}
    assert sorted(r["doc_id"] for r in rows(contamination.clean(table, benchmark))) == [3, 5, 6]


def test_bytes_of_text_ids_and_of_many_texts_with_one_id(spark):
    import hashlib

    from care_episodes.llm import suffix_dedup
    from tests.llm.test_text_dedup import expected_bytes

    shared = prose(3, 40)
    texts = [prose(k, 12) + (shared if k % 3 == 0 else "") + prose(k + 500, 12) for k in range(40)]
    for ids, kind in ((["b", "a", None, "c"], "string"), ([7, 7, None, 2], "long")):
        data = [(ids[k % 4], t) for k, t in enumerate(texts)] + [(ids[0], None), (ids[0], "")]
        got = rows(suffix_dedup.remove_repeats(spark.createDataFrame(data, f"doc_id {kind}, text string")))
        order = sorted(data, key=lambda r: (r[0] is not None, r[0] or type(ids[0])(), hashlib.md5((r[1] or "").encode()).hexdigest()))
        want = expected_bytes([t for _, t in order])
        assert sorted(((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == sorted(((order[k][0], w[1], w[3]) for k, w in want.items()), key=str)
    many = spark.createDataFrame([(None, f"{k} {shared[:120]} {k}") for k in range(600)], "doc_id long, text string")
    assert sum(r["n_removed"] > 0 for r in rows(suffix_dedup.remove_repeats(many))) == 599


def test_vectors_of_extreme_sizes(spark):
    from care_episodes.llm import cover_tree

    data = [(0, [1e-170, 0.0, 2e-170], 1), (1, [1e200, 0.0, 2.1e200], 1), (2, [1.0, 0.0, 2.0], 1), (3, [0.0, 1e300, 0.0], 1), (4, [0.0, 5e-324, 0.0], 1), (5, [float("inf"), 0.0, 0.0], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows(cover_tree.linked(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")))}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (1, 3), 4: (1, 3), 5: (0, 5)}
