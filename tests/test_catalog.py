"""Every registered query equals its DuckDB oracle (sf0.001), and entry() runs."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from helpers import SF001
from txnwatch.plans import catalog, oracle

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order)
                                           for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 24   # R2 21 + R3 3 at the default thresholds
    assert df.columns == ["alert_id", "rule_type", "transaction_id", "user_hash", "amount",
                          "timestamp", "trigger_detail", "alert_time"]
