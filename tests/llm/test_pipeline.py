import duckdb
import pytest

import corpus_pipeline
from care_episodes.llm import queries
from tests.llm.helpers import AWKWARD_TEXTS, ascii_lower, corpus, prose, rows
from tests.llm.test_near_dedup import shingles
from tests.llm.test_text_dedup import expected_lines, line_words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents and benchmark; document 300 + k holds item k."""
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = corpus(8, 70)
    data = [(k, t, "en", f"src{k % 4}", 0) for k, t in enumerate(texts)]
    data += [(300 + k, prose(k, 40) + "\n" + prose(7000 + k, 30) + "\n" + prose(900 + k, 20), "en", None, 0) for k in range(5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, prose(7000 + k, 30)) for k in range(5)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_keep_columns_and_decide(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "mixing":
            assert docs.columns == columns
        seen[name] = ({r["doc_id"]: r["text"] for r in rows(before)}, rows(docs))
    given, kept = seen["language_id"]
    assert {r["doc_id"] for r in kept} >= {i for i, t in given.items() if t and len(t) > 60 and t.isascii() and set(ascii_lower(t)) & set("aeiou")}
    assert all(r["text"] and any(c.isalpha() for c in r["text"]) for r in kept)

    given, kept = seen["line_dedup"]
    order = sorted(given)
    gone = expected_lines([given[i] for i in order])
    want = {}
    for k, i in enumerate(order):
        left = "\n".join(x for n, x in enumerate(given[i].split("\n")) if (k, n) not in gone)
        if left == given[i] or line_words(left):
            want[i] = left
    assert {r["doc_id"]: r["text"] for r in kept} == want

    given, kept = seen["near_dedup"]
    sets = {i: shingles(t) for i, t in given.items()}
    drop = {i for i in sets for j in sets if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert {r["doc_id"] for r in kept} == set(given) - drop  # groups here have no chains

    given, kept = seen["decontamination"]
    assert set(given) - {r["doc_id"] for r in kept} == {300 + k for k in range(5)}

    given, kept = seen["mixing"]
    assert {r["doc_id"] for r in kept} <= set(given) and {r["epoch"] for r in kept} <= {1, 2}
    words = {i: len([w for w in t.split() if w]) for i, t in given.items()}
    assert sum(r["size"] for r in kept) == pytest.approx(1.5 * sum(words.values()), rel=0.35)


def test_run_on_given_tables_and_reruns_agree(spark):
    key = lambda df: sorted((r["doc_id"], r["epoch"], r["taken"]) for r in rows(df))
    first = key(corpus_pipeline.run(spark, SF))
    assert first and first == key(corpus_pipeline.run(spark, SF))


def test_run_on_empty_and_awkward_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == []
    data = [(k, t, None, None, None) for k, t in enumerate(AWKWARD_TEXTS)] + [(None, "some words here", "en", "a", 1)] * 2
    spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    corpus_pipeline.run(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in result.description]
    want = sorted(map(str, ([float(v) if isinstance(v, float) else v for v in r] for r in result.fetchall())))
    got = queries.QUERIES[name](spark, SF).select(*columns)
    assert sorted(map(str, ([float(v) if isinstance(v, float) else v for v in r] for r in got.collect()))) == want
