import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from care_episodes.llm import contamination, language, licenses, line_quality, mixing, page_templates
from care_episodes.llm.columns import held_out
from pyspark.sql import functions as F
from tests.llm.helpers import AWKWARD_TEXTS, ascii_lower, docs_of, prose, rows

# ---- language -------------------------------------------------------------------------------
ALPHABETS = {"aa": "aeiou mnl", "bb": "xyzkqw jv", "cc": "éàçùô bdt"}


def sentences(lang, seed, words=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(ALPHABETS[lang].replace(" ", "")) for _ in range(rng.randrange(2, 8))) for _ in range(words))


def language_docs(spark, n=120):
    data = [(k, sentences(lang, k), lang) for k, lang in zip(range(n), itertools.cycle(ALPHABETS))]
    data += [(1000 + k, t, "aa") for k, t in enumerate(AWKWARD_TEXTS)]
    data += [(2000, sentences("aa", 1), None), (3, sentences("aa", 9), "aa"), (2001, "12345 67890 !!", "bb"), (2002, "漢字 " * 200, None)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string").selectExpr("*", "'mine' AS row", "'x' AS lettered")


def test_language_held_out_and_undetermined(spark):
    docs = language_docs(spark)
    got = rows(language.language_digest(docs))
    assert len(got) == docs.count()
    texts = {r["doc_id"]: r for r in rows(docs)}
    for r in got:
        assert 0 <= r["score"] <= 1
        text = texts[r["doc_id"]]["text"]
        if text is None or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in ALPHABETS
        if r["doc_id"] < 120 and r["doc_id"] != 3:
            assert r["lang_pred"] == texts[r["doc_id"]]["lang"] and not r["rejected"]
    assert {r["held_out"] for r in got} == {True, False}
    assert {r["doc_id"]: r["rejected"] for r in got}[2002]


def test_language_model_ignores_held_out_labels(spark):
    docs = language_docs(spark)
    wrong = docs.withColumn("lang", F.when(held_out(F.col("doc_id"), 4, 2), "zz").otherwise(F.col("lang")))
    key = lambda df: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in rows(language.language_digest(df)))
    assert key(wrong) == key(docs)


def test_language_without_examples_and_empty_table(spark):
    docs = language_docs(spark, 6).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in rows(language.language_digest(docs))} == {"und"}
    assert rows(language.language_digest(docs.limit(0))) == []
    kept = language.identify(docs, language.learn(language.learned_rows(language_docs(spark))))
    assert set(docs.columns) <= set(kept.columns)


# ---- quality --------------------------------------------------------------------------------
def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    bounds, good, chain = np.array([0, 3, 3, 4, 8]), rng.normal(size=8) * 2, rng.normal(size=(2, 2))
    chance, pairs, total = line_quality.marginals(good, chain, bounds)
    expected = np.zeros((2, 2))
    for a, b, z in zip(bounds[:-1], bounds[1:], total):
        if a == b:
            continue
        weights = {
            y: np.exp(sum(good[a + t] * y[t] for t in range(b - a)) + sum(chain[y[t], y[t + 1]] for t in range(b - a - 1)))
            for y in itertools.product((0, 1), repeat=b - a)
        }
        whole = sum(weights.values())
        assert np.isclose(z, np.log(whole))
        for t in range(b - a):
            assert np.isclose(chance[a + t], sum(w for y, w in weights.items() if y[t]) / whole)
        for t in range(b - a - 1):
            for y, w in weights.items():
                expected[y[t], y[t + 1]] += w / whole
    assert np.allclose(pairs, expected)


def quality_tables(spark, n=150):
    docs, labels = [], []
    for k in range(n):
        good = k % 3 != 0
        text = prose(k, 60).replace(". ", ".\n")
        if not good:
            text = "\n".join(re.sub(r"(\w+)", r"\1$$$" if k % 2 else r"\1 \1 \1", line) for line in text.split("\n"))
        docs.append((k, text))
        labels.append((k, int(good), 0))
    docs += [(1000 + k, t) for k, t in enumerate(AWKWARD_TEXTS)]
    labels += [(5, 1 - labels[5][1], 0), (1000, None, 0), (99999, 1, 0)]
    schema = "doc_id long, quality int, toxic int"
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS label", "'x' AS score"), spark.createDataFrame(labels, schema), dict((a, b) for a, b, _ in labels[:n])


def test_quality_on_held_out_documents(spark):
    docs, labels, truth = quality_tables(spark)
    got = rows(line_quality.quality_digest(docs, labels))
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held) > 20
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[1000] == by_id[1001]  # null and empty


def test_quality_without_labels_one_class_and_empty(spark):
    docs, labels, _ = quality_tables(spark, 12)
    assert {r["score"] for r in rows(line_quality.quality_digest(docs, labels.limit(0)))} == {0.5}
    assert {r["score"] for r in rows(line_quality.quality_digest(docs, labels.where("quality = 1 and doc_id <> 5")))} == {1.0}
    assert rows(line_quality.quality_digest(docs.limit(0), labels)) == []


# ---- licences -------------------------------------------------------------------------------
LICENSE_TEXTS = [
    "Released under the MIT License. Licensed under CC BY-NC 4.0. under the mit license", "Licensed under the Apache License, Version 2.0.",
    "cc by nc cc-by-nc CC\tBY\nNC", "under the\nmit license_under the mit licenses", "SPDX-License-Identifier: BSD-3-Clause",
    "This work is licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1", "éunder the mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "accc bync", "under the mit license " * 500,
]


def expected_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    places = [
        (k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
    ]
    at = [k for k, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def test_licenses_base_columns_match_plain_search(spark):
    texts = AWKWARD_TEXTS + LICENSE_TEXTS + [prose(k, 50) + " " + LICENSE_TEXTS[k % 8] for k in range(30)]
    docs = docs_of(spark, texts, extra=True)
    for r in rows(licenses.license_digest(docs)):
        got = tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
        assert got == expected_base(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert licenses.scan_licenses(docs).count() == len(texts)
    assert rows(licenses.license_digest(docs.limit(0))) == []


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("spdx license identifier bsd 3 clause", {"bsd-3"}), ("licensed under the gnu general public license version 3", {"gpl-3"}),
        ("gnu lesser general public license v2 1", {"lgpl-2.1"}), ("cc by nc sa 4 0", {"cc-by-nc", "cc-by-nc-sa"}),
        ("the mozilla public license version 2 0", {"mpl-2"}), ("licensed under a license", {"unknown-license"}), ("all rights reserved", {"all-rights-reserved"}),
    ],
)
def test_licenses_rules_and_suppression(text, labels):
    taken, _ = licenses.scan(text, licenses.rules())
    assert {t[2] for t in taken} == labels


def test_licenses_every_name_passes_the_roots():
    for label, spdx, name, keyword in licenses.FAMILIES:
        example = f"spdx license identifier {spdx}".encode()
        assert any(r in example for r in licenses.ROOTS) and licenses._ROOT_WORDS.search(example)
    assert len(licenses.rules()) > 250


# ---- decontamination ------------------------------------------------------------------------
def plain_alignment(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = max(0, table[i, j] + (10 if a[i] == b[j] else -6), table[i, j + 1] - 6, table[i + 1, j] - 6)
    return table.max() / 10


def test_alignment_matches_plain_table():
    rng = np.random.default_rng(1)
    items = [rng.integers(1, 9, rng.integers(1, 20)).astype(np.uint64) for _ in range(60)]
    texts = [rng.integers(1, 9, rng.integers(0, 30)).astype(np.uint64) for _ in range(60)]
    got = contamination.smith_waterman(items, texts)
    assert np.allclose(got, [plain_alignment(a, b) for a, b in zip(items, texts)])


def test_leaks_exact_edited_and_clean(spark):
    items = [(k, prose(9000 + k, 25)) for k in range(12)] + [(50, None), (51, ""), (52, "one two"), (7, prose(9500, 30))]
    docs, leaked = [], set()
    for k in range(80):
        text = prose(k, 80)
        if k % 4 == 0:
            item, passage = items[k % 12]
            words = passage.split()
            if k % 8 == 0:
                for e in range(3):  # replaced, dropped and added words
                    words[2 + 8 * e : 3 + 8 * e] = [["other"], [], ["and", "more"]][e]
            text += "\n" + " ".join(words).upper() + "\n" + prose(500 + k, 40)
            leaked.add((k, item))
        docs.append(text)
    docs += AWKWARD_TEXTS
    leaked.add((80 + AWKWARD_TEXTS.index("one two\nONE TWO\n\none  two."), 52))  # short items must be there in full
    table = docs_of(spark, docs, extra=True)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows(contamination.leaks(table, benchmark))}
    assert set(got) == leaked
    assert all(s == 1 for (d, _), s in got.items() if d % 8 or d >= 80) and all(0.5 <= s < 1 for (d, _), s in got.items() if d % 8 == 0)
    kept = contamination.clean(table, benchmark)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in rows(kept)} == set(range(len(docs))) - {d for d, _ in leaked}
    assert rows(contamination.leaks(table.limit(0), benchmark)) == [] and rows(contamination.leaks(table, benchmark.limit(0))) == []


@pytest.mark.parametrize("apart", [4, 5, 6])
def test_leaks_with_a_word_changed_every_few(spark, apart):
    items = [(k, " ".join(f"i{k}w{j}" for j in range(n))) for k, n in enumerate([11, 15, 17, 25, 40])]
    docs = []
    for k, item in items:
        words = item.split()
        for j in range(apart - 1, len(words), apart):
            words[j] = f"other{j}"
        docs.append(f"{prose(k, 30)} {' '.join(words)} {prose(50 + k, 30)}")
    want = {}
    for d, text in enumerate(docs):
        for k, item in items:
            score = plain_alignment(item.split(), re.findall(r"\w+", text.lower())) / len(item.split())
            if score >= 0.5:
                want[d, k] = pytest.approx(score)
    got = rows(contamination.leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")))
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == want and set(want) == {(k, k) for k in range(5)}


def test_leaks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 50)
    items = [(k, prose(9000 + k, 25)) for k in range(12)]
    table = docs_of(spark, [items[k % 12][1] for k in range(24)])
    got = {(r["doc_id"], r["item_id"]) for r in rows(contamination.leaks(table, spark.createDataFrame(items, "item_id long, text string")))}
    assert got == {(k, k % 12) for k in range(24)}


# ---- pages ----------------------------------------------------------------------------------
def main_text(html):
    return page_templates.main_text(html, [], {})


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><h1>T &amp; u</h1><p>a  b<p>c <b>d</b>e</article>", "T & u\na b\nc de"),
        ("<body><nav>menu</nav><p>kept</p><footer>f</footer>", "kept"),
        ("<main><p>one</p><div class='ad-box'>buy</div><aside>x</aside><p>two</p></main><p>out</p>", "one\ntwo"),
        ("<article><p>x<script>var t='</p>'; if (a<b) {}</script>y</p><style>p{}</style><!-- no --></article>", "xy"),
        ("<article><p>a</p><section id=comments><p>no</p></section><form><p>f</p></form><p>5 < 6 &lt;b&gt; &#233;</p></article>", "a\n5 < 6 <b> é"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
        ("<article><p>open <b>bold<p>next</article><footer>foot", "open bold\nnext"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b</table></article>", "1\n2\na\nb"),
        ("<article><!-- open comment", ""), ("<article><script>open", ""), ("plain text", "plain text"), ("", ""), ("<", "<"), ("</p></p>", ""),
    ],
)
def test_page_text(html, text):
    assert main_text(html) == text


def test_page_templates_of_hosts(spark):
    def page(host, k, notice="Sign up for our letter."):
        return f"<html><body><div><p>{notice}</p><ul>{'<li><a href=x>menu</a></li>' * 2}</ul></div><p>{prose(k, 12)}</p><p>own {host} {k}</p></body></html>"

    data = [(k, f"https://big.example/{k}", page("big", k)) for k in range(12)] + [(100 + k, f"http://small.example/{k}", page("small", k)) for k in range(3)]
    data += [(200, None, "<p>x</p>"), (201, "https://big.example/null", None), (202, "nonsense", ""), (0, "https://big.example/0", page("big", 0))]
    df = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'mine' AS text", "1 AS row", "2 AS host")
    got = rows(page_templates.extraction_digest(df))
    assert len(got) == len(data)
    for r in got:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] < 100:
            assert "Sign up" not in r["text"] and "menu" not in r["text"] and f"own big {r['page_id']}" in r["text"]
        elif r["page_id"] < 200:
            assert "Sign up" in r["text"] and "own small" in r["text"]
    assert {r["page_id"]: r["text"] for r in got}[200] == "x"
    assert page_templates.extract(df).count() == len(data)
    assert rows(page_templates.extraction_digest(df.limit(0))) == []


# ---- mixing ---------------------------------------------------------------------------------
def plain_targets(sizes, share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full: set = set()
    while True:
        rest = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        left = sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and cap * sizes[s] <= weight[s] * rest / left}
        if not more:
            return {s: cap * sizes[s] if s in full else weight[s] * rest / left for s in names}
        full |= more
        if len(full) == len(names):
            return {s: cap * sizes[s] for s in names}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    names = [f"s{k}" for k in range(7)] + [None, "Z", "é", ""]
    data = [(k, prose(k, rng.choice([0, 1, 5, 80])) if k % 17 else None, rng.choice(names if k % 3 else names[:1])) for k in range(400)]
    data += [(0, data[0][1], data[0][2]), (None, "a b c", "s1")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr("*", "'mine' AS size", "1 AS place")
    got = rows(mixing.mix_digest(df))
    again = rows(mixing.mix_digest(df.repartition(7)))
    key = lambda rs: sorted(map(str, rs))
    assert len(got) == len(data) and key(got) == key(again)
    source = {k: s for k, _, s in data}
    sizes, taken, target, most = {}, {}, {}, {}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        most[s] = max(most.get(s, 0), r["size"])
        target[s] = r["target"]
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 2 * r["size"]
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= most[s]
    out = mixing.repeat_rows(mixing.mix(df))
    assert out.count() == sum(r["taken"] // r["size"] for r in got if r["size"]) + sum(1 for _ in rows(out.where("size = 0")))


def test_mix_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert rows(mixing.mix_digest(spark.createDataFrame([], schema))) == []
    got = rows(mixing.mix_digest(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema)))
    assert {(r["size"], r["target"], r["taken"]) for r in got} == {(0, 0.0, 0)}


def test_slices_keep_every_row():
    from care_episodes.llm.buffers import slices, utf8

    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 50, None, "", "é" * 9, "x" * 500, "y"])})
    parts = list(slices(iter([batch.slice(1), batch]), "text", most_bytes=60, most_rows=2))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()[1:] + batch.column(0).to_pylist()
    for p in parts:
        data, offsets = utf8(p.column(0))
        assert [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])] == [t or "" for t in p.column(0).to_pylist()]
