"""Every SQL-class registered query equals its DuckDB oracle (sf0.001; streaming ones too)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from trendlens.plans.compare import compare_frames

TABLES = ("events", "documents", "pages", "part", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["keyword", "approx_count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    ok, why = compare_frames(got, want)
    assert ok, why


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only(spark, name):
    assert E.queries()[name](spark, SF001).count() >= 0


def test_no_data_written_into_repo():
    assert not os.path.exists(os.path.join(os.path.dirname(os.path.dirname(__file__)), "spark-warehouse"))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_types(spark, con, name):
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in E.queries()[name](spark, SF001).schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
