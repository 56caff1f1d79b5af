"""Every registered query against its DuckDB oracle on the smallest tables (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from hitroll.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "float": "FLOAT", "boolean": "BOOLEAN"}


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 4)
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:                # compared with brute force in its own test module
        assert rows
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, res.fetchall())
    rel = con.sql(sql)
    otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    assert stypes == otypes


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["dataset", "mean_score", "std_score", "n_structures"]
    assert df.count() == 5
