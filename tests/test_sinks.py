import pytest

from txnrisk.operators.validate import missing_columns
from txnrisk.sources import sinks
from txnrisk.sources.channels import read_channel_dir, unify_transactions


def test_missing_channels_are_skipped(spark, tmp_path):
    d = tmp_path / "exports"
    spark.createDataFrame([(1, 5.0, "D", "2024-01-01 10:00:00")],
                          "customer_id long, amount double, debit_credit string, transaction_datetime string") \
        .write.option("header", True).csv(str(d / "abm.csv"))
    spark.createDataFrame([(2, 7.0, "C", "not a date", "5411.0")],
                          "customer_id long, amount_cad double, debit_credit string, transaction_datetime string, "
                          "merchant_category string").write.option("header", True).csv(str(d / "card.csv"))
    ch = read_channel_dir(spark, str(d))
    assert set(ch) == {"ABM", "Card"}
    t = {r["customer_id"]: r for r in unify_transactions(ch).collect()}
    assert t[1]["amount_cad"] == 5.0 and t[1]["channel"] == "ABM" and t[1]["country"] is None
    assert t[2]["transaction_datetime"] is None          # unparsable -> NULL
    with pytest.raises(FileNotFoundError):
        read_channel_dir(spark, str(tmp_path / "nothing"))


def test_explanations_csv_and_batch_checkpoint(spark, tmp_path):
    ex = spark.createDataFrame([(1, 'says "hi"\nthere '), (2, "ok")], "customer_id long, explanation string")
    out = tmp_path / "expl"
    sinks.write_explanations(ex, str(out))
    text = "".join(p.read_text() for p in out.glob("*.csv"))
    assert '"1","says ""hi"" there"' in text and text.startswith('"customer_id","explanation"')
    req = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "batch_id int, customer_id long")
    done = str(tmp_path / "done")
    assert sinks.pending_batches(spark, req, done).count() == 3
    sinks.append_batch_results(req.where("batch_id = 0").withColumnRenamed("customer_id", "cid"), done)
    left = sinks.pending_batches(spark, req, done).collect()
    assert [r["batch_id"] for r in left] == [1]


def test_a_run_that_ends_early_leaves_no_duplicate_and_no_loss(spark, tmp_path):
    done = str(tmp_path / "done")
    rows = spark.createDataFrame([(b, c, f"answer {c}") for b in range(3) for c in range(10 * b, 10 * b + 4)],
                                 "batch_id int, customer_id long, explanation string")
    sinks.append_batch_results(rows.where("batch_id = 0"), done)
    # ends between the rows and the ledger, with fewer and other rows than the next run has
    sinks.write_batch_rows(rows.where("batch_id = 1 and customer_id < 12").selectExpr("batch_id", "customer_id", "'old' AS explanation"), done)
    assert sinks.finished_batches(spark, done).count() == 4
    todo = sinks.pending_batches(spark, rows, done)
    assert sorted(r.batch_id for r in todo.select("batch_id").distinct().collect()) == [1, 2]
    sinks.append_batch_results(todo, done)
    got = sorted((r.batch_id, r.customer_id, r.explanation) for r in sinks.finished_batches(spark, done).collect())
    assert got == sorted(tuple(r) for r in rows.collect())
    assert sinks.pending_batches(spark, rows, done).count() == 0
    sinks.append_batch_results(rows.where("batch_id = 2"), done)  # done again
    assert sinks.finished_batches(spark, done).count() == rows.count()
    sinks.append_batch_results(rows.limit(0), done)
    assert sinks.finished_batches(spark, done).count() == rows.count()


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "customer_id long, x double")
    assert missing_columns(df, ["customer_id", "y", "x"]) == ["y"]
