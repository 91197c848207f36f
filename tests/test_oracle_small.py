"""Spark queries equal their DuckDB oracle on the smallest test tables."""

import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"

KEYS = ["unify_transactions", "feature_table", "rule_scores", "indicator_trace", "log_transform", "fusion",
        "roc_auc", "evidence_batches", "narratives", "reconcile_responses", "cooccurrence_edges",
        "stream_daily_flow"]
TABLES = ["customer", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(df):
    import pandas as pd

    df = df[sorted(df.columns)].astype(object)
    rows = []
    for r in df.itertuples(index=False):
        rows.append(tuple(None if pd.isna(v) else (float(v) if isinstance(v, (int, float)) else v) for v in r))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    import __spark_entry__ as E

    s = E.queries()[key](spark, SF_SMALL).toPandas()
    o = con.execute(E.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert _canon(s) == _canon(o)
