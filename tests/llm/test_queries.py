"""Queries against their SQL, and the pipeline against plain rules, on a small scale."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from aggrex.llm import decontaminate, pii, toxicity
from aggrex.llm.queries import ORACLE, QUERIES
from compare import rows
from compare import rows as rows_of
from plain import simhash_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_operator_has_a_query():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, db):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(db.execute(ORACLE[name]).df())


def test_url_lists_equal_sql_on_odd_urls(spark, tmp_path):
    """Paths with upper-case letters, hosts with ports, users and closing dots, and what is no URL."""
    urls = ["http://Example.com/Dir/Page", "https://EXAMPLE.com/dir/page", "http://user@a.Example.com:8080/x/Y/",
            "http://a.example.com./x/Y/z", "HTTPS://b.org", "http://b.org:80", "ftp://b.org/x", "", None, "http:///x",
            "http://c.net?q=A/b", "http://c.net/A/b#f"]
    rows = [(i, urls[i % len(urls)]) for i in range(900)] + [(5, urls[1])]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = QUERIES["op2_url_list_asof"](spark, str(tmp_path)).toPandas()
    assert got.blocked.any() and rows_of(got) == rows_of(con.execute(ORACLE["op2_url_list_asof"]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_a_row_for_every_document(name, spark, docs):
    got = QUERIES[name](spark, SF)
    ids = sorted(r.doc_id for r in got.select("doc_id").collect())
    every = sorted(r.doc_id for r in docs.select("doc_id").collect())
    # Operators that search list the documents they find something in.
    assert set(ids) < set(every) if name.startswith("op3_") else ids == every


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(3), SF).columns == docs.columns


def test_pipeline_equals_plain_rules(spark):
    """Each stage by its rule, one after the other, on the driver."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.learn(docs, labels)
    reader = toxicity.FeatureReader(model.features)
    left = [(r.doc_id, r.text) for r in docs.collect() if model.at_least(sorted(reader.read(r.text)))[0] < 0.5]
    first = {d for d, _, c in simhash_components(left) if d == c}
    left = [(d, t) for d, t in left if d in first]

    from plain import edit_distance_within
    kept = []
    for d, t in left:
        words = t.lower().split()
        there = set(words)
        near = [x.lower().split() for _, x in items]
        if not any(len(set(x) - there) <= decontaminate.budget(len(x))
                   and edit_distance_within(x, words) <= decontaminate.budget(len(x)) for x in near):
            kept.append((d, t))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in pii.redact(spark.createDataFrame(kept, "doc_id long, text string")).collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
