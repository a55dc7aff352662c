"""The registered corpus queries: against their SQL, and the pipeline stage by stage."""

import os

import duckdb
import pytest

import corpus_pipeline
from siteweave.llm import decontaminate, queries, quality

SF = "/root/testdata/sf0.001"


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    cur = con.execute(queries.SQL[name])
    names = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(map(norm, r)) for r in df.select(*names).collect()) == sorted(tuple(map(norm, r)) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_others_cover_the_table(spark, name):
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in queries.QUERIES[name](spark, SF).select("doc_id").collect()} == docs


def test_the_model_beats_single_words_on_held_out_texts(spark):
    held = queries.op2_lm_scores(spark, "/root/testdata/sf0.01").where("held_out").groupBy().sum("score", "base_score").first()
    assert held[0] > held[1]


def test_pipeline(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    docs, kept = raw, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if i < 4:
            assert docs.columns == raw.columns
            docs = docs.cache()
            kept.append({r.doc_id: r for r in docs.collect()})
    assert set(kept[0]) == {r.doc_id for r in quality.quality(raw).where("kept").collect()}
    assert set(kept[1]) < set(kept[0]) and set(kept[3]) == set(kept[2]) == set(kept[1])
    texts = [r.text for r in kept[1].values()]
    assert len(set(texts)) == len(texts)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = spark.createDataFrame(list(kept[2].values()), raw.schema)
    assert decontaminate.report(clean, bench).where("contaminated").count() == 0
    assert all(r.n_chars == len(r.text) for r in kept[3].values())
    assert {r.doc_id for r in docs.select("doc_id").collect()} == set(kept[3])
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_pipeline_on_odd_tables(spark):
    """No rows, nulls in every column, repeated rows, a very long text and extra columns of names used inside."""
    names = "__row, row, key, th, keeper, __text, __spans, __parts, __new, again".split(", ")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in names)
    words = [f"word{i}" for i in range(90)] + ["the", "of", "and", "to"] * 6
    good, extra = " ".join(words), tuple(f"kept {n}" for n in names)
    rows = [(1, good, "en", "s", 9, *extra), (1, good, "en", "s", 9, *extra), (None, None, None, None, None, *[None] * 10), (3, "", None, None, 0, *extra), (4, " ".join(f"{w}x{i}" if i % 3 else w for i in range(300) for w in words), "en", "s", 1, *extra)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        full = docs.count() > 0
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF)
            if i < 4:
                assert docs.columns[5:] == names
                docs = docs.cache()
                got = docs.collect()
                assert sorted(r.doc_id for r in got) == ([] if not full else [1, 1, 4] if i == 0 else [1, 4])
                assert all(tuple(r[5:]) == extra for r in got)
        assert (docs.count() > 0) == full
