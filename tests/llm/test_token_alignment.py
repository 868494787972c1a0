"""Token alignment against a plain per-token version."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest

from care_episodes.llm import token_alignment as T
from tests.llm.helpers import corpus, docs_of, rows

pytestmark = pytest.mark.skipif(not os.path.exists(T.BYTE_BPE), reason="no vocabulary files")

ODD = [
    "a <|endoftext|> inside", "▁lower block ▁▁", "é and ﬁ ligature", "漢字かな交じり文 🙂🙃", "  two  spaces\n\n\tand tab ", "ﬁ", " nbsp",
    "x" * 20000, "nul\x00inside", "<0x41> as text", "</s><unk>", " ", "\n", "a", "same text", "same text", "đ" * 300,
]


def expected(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(T.BYTE_BPE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=T.PIECES)
    alphabet = T.byte_level_alphabet()
    out, held = [], Counter()
    for text in texts:
        empty = {"n_a": 0, "n_b": 0, "n_groups": 0, "links": [], "sha": ""}
        if not text:
            out.append(empty)
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if len(p := b.id_to_piece(i)) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            out.append(empty)
            continue

        def spans(parts):
            at, found = 0, []
            for p in parts:
                found.append((at, at + len(p)))
                at += len(p)
            return found

        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        group = lambda end: next(k for k, c in enumerate(cuts) if end <= c) if len(cuts) < 300 else __import__("bisect").bisect_left(cuts, end)
        parts = defaultdict(lambda: ([], []))
        for i, (_, e) in zip(ids_a, spans_a):
            parts[group(e)][0].append(i)
        for i, (_, e) in zip(ids_b, spans_b):
            parts[group(e)][1].append(i)
        said = ";".join(",".join(map(str, parts[k][0])) + "|" + ",".join(map(str, parts[k][1])) for k in range(len(cuts)))
        links, j = [], 0
        for i, (s, e) in zip(ids_a, spans_a):
            while spans_b[j][1] <= s:
                j += 1
            k = j
            while k < len(spans_b) and spans_b[k][0] < e:
                links.append((i, ids_b[k]))
                k += 1
        held.update(set(links))
        out.append({"n_a": len(ids_a), "n_b": len(ids_b), "n_groups": len(cuts), "links": links, "sha": hashlib.sha256(said.encode()).hexdigest()})
    most = Counter()
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [
        (k, x["n_a"], x["n_b"], x["n_groups"], len(x["links"]), sum(held[p] == most[p[0]] for p in x["links"]), sum(held[p] for p in x["links"]), x["sha"])
        for k, x in enumerate(out)
    ]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block", [1 << 12, 1 << 22])
def test_alignment_matches_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK_BYTES", block)
    texts = corpus(5, 30) + ODD
    random.Random(3).shuffle(texts)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in rows(T.align_corpus(docs_of(spark, texts, extra=True))))
    assert got == sorted(expected(texts))


def test_alignment_of_repeated_null_and_string_ids_and_of_no_rows(spark):
    df = spark.createDataFrame([("a", "one text"), ("a", "one text"), (None, "one text"), (None, None)], "doc_id string, text string")
    got = rows(T.align_corpus(df))
    assert sorted((r["doc_id"] or "", r["n_a"], r["count_sum"]) for r in got) == [("", 0, 0), ("", 2, 6), ("a", 2, 6), ("a", 2, 6)]
    assert rows(T.align_corpus(df.limit(0))) == []
    assert [r["groups_sha256"] for r in rows(T.align_corpus(df.where("text is null")))] == [""]
