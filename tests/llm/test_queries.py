"""The registered queries on the smallest tables, beside SQL or the library's plain checks."""

import duckdb
import pytest
from stardw.llm import queries

import corpus_pipeline
from check import TABLES, normal

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return db


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in queries.ORACLES:
        result = duck.execute(queries.ORACLES[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert normal(df.columns, rows) == normal(columns, result.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    last = docs.count()
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        n = kept.count()
        assert 0 < n <= last
        docs, last = kept, n
    found = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in found.collect()} <= {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_an_empty_table(spark, stage):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert stage(spark, docs, FOLDER).count() == 0
