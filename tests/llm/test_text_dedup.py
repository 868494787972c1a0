import hashlib
import random

import pytest

from care_episodes.llm import line_dedup, suffix_dedup
from tests.llm.helpers import ascii_lower, corpus, docs_of, prose, rows

import re


def line_words(line):
    return tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(line)))


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected_lines(texts):
    lines = [(i, n, line_words(line)) for i, t in enumerate(texts) if t is not None for n, line in enumerate(t.split("\n"))]
    lines = [x for x in lines if x[2]]
    gone = set()
    for k, (i, n, words) in enumerate(lines):
        for j, m, other in lines[:k]:
            if words == other or (len(words) >= 8 and len(other) >= 8 and within_one(words, other)):
                gone.add((i, n))
                break
    return gone


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_match_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = corpus(seed, 40)
    lines = [line for t in texts if t for line in t.split("\n") if len(line.split()) > 8]
    for _ in range(40):  # lines with one word inserted, deleted, replaced; with two; doubled words
        words = rng.choice(lines).split()
        for _ in range(rng.choice([1, 1, 2])):
            k = rng.randrange(len(words))
            words[k : k + rng.choice([0, 1])] = rng.choice([[], ["new"], [words[k], words[k]]])
        texts.append(" ".join(words) + "\n" + prose(rng.randrange(10**6), 15))
    want = expected_lines(texts)
    docs = docs_of(spark, texts, extra=True)
    got = rows(line_dedup.removed_lines(docs))
    assert {(r["doc_id"], r["line"]) for r in got} == want
    assert any(r["near"] for r in got)
    for r in rows(line_dedup.digest(docs)):
        t = texts[r["doc_id"]]
        gone = {n for i, n in want if i == r["doc_id"]}
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        assert r["n_removed"] == len(gone) and r["n_lines"] == (0 if t is None else t.count("\n") + 1)
        assert r["left_md5"] == (None if left is None else hashlib.md5(left.encode()).hexdigest())
    kept = line_dedup.clean(docs)
    assert kept.columns == docs.columns
    found = {r["doc_id"]: r["text"] for r in rows(kept)}
    for i, t in enumerate(texts):
        gone = {n for k, n in want if k == i}
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        if gone and not line_words(left):
            assert i not in found
        else:
            assert found[i] == left


def test_lines_repeated_rows_and_empty_table(spark):
    text = "this line of nine words stands in every row\nother"
    df = spark.createDataFrame([(2, text), (2, text), (9, text), (None, "a b c")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in rows(line_dedup.digest(df)))
    assert got == [(-1, 0), (2, 0), (2, 0), (9, 2)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rows(line_dedup.digest(empty)) == [] and rows(line_dedup.clean(empty)) == []


def expected_bytes(texts):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("many", [64, 2])
def test_bytes_match_all_windows(spark, monkeypatch, many):
    if many == 2:  # every bucket that occurs twice goes the way of shared ones
        monkeypatch.setattr(suffix_dedup, "SPARSE", 1)
        monkeypatch.setattr(suffix_dedup, "MANY", 2)
        monkeypatch.setattr(suffix_dedup, "TOGETHER", 50)
    texts = corpus(4, 50)
    passage = prose(77, 60)
    texts += [prose(500 + k, 30) + passage[k : 200 + k] + prose(600 + k, 30) for k in range(8)]
    texts += ["ab" * 400, "ab" * 90 + "x" + "ab" * 90, passage * 3, "é" * 120, "y" * 99, "y" * 100, "y" * 101]
    want = expected_bytes(texts)
    got = {r["doc_id"]: tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in rows(suffix_dedup.remove_repeats(docs_of(spark, texts, extra=True)))}
    assert got == want


def test_bytes_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)
    texts = corpus(5, 25)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffix_dedup.remove_repeats(docs_of(spark, texts)))}
    assert got == expected_bytes(texts)


def test_bytes_repeated_rows_and_empty_table(spark):
    text = prose(9, 80)
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, "short")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in rows(suffix_dedup.remove_repeats(df)))
    assert got == [(-1, 0), (1, 0), (1, 0), (2, len(text.encode()))]
    assert rows(suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))) == []
