"""The staged transaction table and how it is built."""

from txnrisk.plans import pipeline as P
from txnrisk.sources import fixtures as FX
from txnrisk.sources.channels import clean_transactions, with_time_columns

SF = "/root/testdata/sf0.001"


def test_staged_transactions_lie_by_customer_without_derived_columns(spark):
    txn = P.fixture_inputs(spark, SF).txn
    plain = with_time_columns(clean_transactions(FX.fixture_transactions(spark, SF)))
    columns = sorted(plain.columns)
    assert sorted(txn.columns) == columns
    assert txn.select(columns).exceptAll(plain.select(columns)).isEmpty()
    assert txn.count() == plain.count()
    files = txn.inputFiles()
    assert files
    for f in files:
        stored = spark.read.parquet(f)
        assert not {"hour", "day_of_week", "year_month", "date"} & set(stored.columns)
        ids = [r.customer_id for r in stored.coalesce(1).collect()]
        assert ids == sorted(ids)


def test_lines_meet_their_orders_unsorted(spark):
    plan = FX.fixture_transactions(spark, SF)._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_staging_sorts_rows_by_customer_alone(spark, monkeypatch):
    """No sort by channel, whose ties are compared row by row."""
    plans, write = [], P.write_stage_table

    def seen(df, name, partition_by=None):
        plans.append((df._jdf.queryExecution().executedPlan().toString(),
                      spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        return write(df, name, partition_by)

    monkeypatch.setattr(P, "write_stage_table", seen)
    P.fixture_inputs(spark, SF)
    (plan, writers), = plans
    assert "Sort [customer_id" in plan and "Sort [channel" not in plan
    assert int(writers) > len({"ABM", "Card", "Cheque", "EFT", "EMT", "WesternUnion", "Wire"})
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
