import pytest

import corpus_pipeline
from riskframe.llm.queries import QUERIES
from riskframe.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_rows_follow(spark, awkward):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        docs = got
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_stages_on_an_empty_table(spark, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name


def test_run_reruns_alike(spark):
    rows = [sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect()) for _ in range(2)]
    assert rows[0] == rows[1] and rows[0]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())
