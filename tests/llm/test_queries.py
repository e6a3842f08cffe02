"""The corpus queries against their SQL on the smallest test tables."""

import math
from pathlib import Path

import duckdb
import pytest

from stratacast.llm import queries as corpus

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def cells(rows, order):
    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value)
        return str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(corpus.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = corpus.QUERIES[name](spark, str(SF_DIR))
    relation = duck.execute(corpus.ORACLES[name])
    found = [d[0] for d in relation.description]
    assert sorted(df.columns) == sorted(found)
    names = sorted(found)
    want = cells(relation.fetchall(), [found.index(n) for n in names])
    assert cells(df.collect(), [df.columns.index(n) for n in names]) == want


@pytest.mark.parametrize("name", sorted(set(corpus.QUERIES) - set(corpus.ORACLES)))
def test_other_query_has_a_row_per_document(spark, name):
    df = corpus.QUERIES[name](spark, str(SF_DIR))
    documents = spark.read.parquet(str(SF_DIR / "documents.parquet"))
    assert df.select("doc_id").distinct().count() == documents.select("doc_id").distinct().count()
