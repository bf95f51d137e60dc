"""Every query of the library itself against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, canonical
from vexel.plans.oracles import ORACLES
from vexel.plans.queries import all_queries

NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def test_every_query_has_its_sql():
    assert NAMES == sorted(ORACLES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


def kinds(df):
    out = {}
    for name, kind in df.dtypes.items():
        nullable = str(kind) == "float64" and df[name].isna().any()
        whole = nullable and (df[name].dropna() % 1 == 0).all()
        out[name] = "int64" if whole else str(kind).replace("Int64", "int64")
    return out


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, sql, name):
    got = all_queries()[name](spark, sf_dir).toPandas()
    want = sql.execute(ORACLES[name]).df()
    # A whole-number column with a NULL comes back as doubles on one side or the other.
    assert kinds(got) == kinds(want)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    hits = entry.entry(spark)
    assert hits.columns == ["rank", "score", "doc_id", "pos", "chunk"]
    assert hits.count() == 10
