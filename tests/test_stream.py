from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txnrisk.plans import queries as Q
from txnrisk.streaming import daily_flow as SD
from txnrisk.streaming import event_windows as EW

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("files,per_trigger", [(5, 2), (24, 8), (100, 7)])
def test_stream_equals_batch_at_any_file_count(spark, tmp_path, files, per_trigger):
    txn = Q.inputs(spark, SF).txn
    src = str(tmp_path / "source")
    SD.land(txn.repartition(files), src)
    SD.run_daily_flow(spark, src, str(tmp_path / "sink"), str(tmp_path / "ckpt"), files_per_trigger=per_trigger)
    got = {(r.customer_id, r.day): r for r in SD.windows(spark, str(tmp_path / "sink")).collect()}
    want = {(r.customer_id, r.day): r for r in SD.daily_flow(spark.read.schema(SD.TXN_STREAM_SCHEMA).parquet(src)).collect()}
    assert got.keys() == want.keys()
    assert sum(r.n_txn for r in got.values()) == txn.where("transaction_datetime is not null").count()
    for k, w in want.items():
        assert got[k].n_txn == w.n_txn and got[k].count_near_10k == w.count_near_10k
        assert abs(got[k].volume - w.volume) < 1e-6 * max(1.0, abs(w.volume))


def test_stream_resumes(spark, tmp_path):
    txn = Q.inputs(spark, SF).txn
    src, sink, ckpt = (str(tmp_path / x) for x in ("source", "sink", "ckpt"))
    for part in (0, 1):
        SD.land(txn.where(f"customer_id % 2 = {part}").repartition(3), src)
        SD.run_daily_flow(spark, src, sink, ckpt, files_per_trigger=2)
    n = SD.windows(spark, sink).selectExpr("sum(n_txn)").first()[0]
    assert n == txn.where("transaction_datetime is not null").count()


def rows_of(spark, rows):
    return spark.createDataFrame([(c, float(a), d, datetime.fromisoformat(t), "EFT") for c, a, d, t in rows],
                                 "customer_id long, amount_cad double, debit_credit string, "
                                 "transaction_datetime timestamp_ntz, channel string")


def test_windows_leave_once_and_late_rows_are_counted(spark, tmp_path):
    src, sink, ckpt, arrived = (str(tmp_path / x) for x in ("source", "sink", "ckpt", "arrived"))

    def run():
        EW.run_daily_windows(spark, src, sink, ckpt, "1 day")
    SD.land(rows_of(spark, [(1, 9500, "C", "2024-01-01T10:00"), (2, 5, "D", "2024-01-01T23:59:59"),
                            (1, 7, "D", "2024-01-02T00:00"), (1, 1, "C", "2024-01-05T12:00")]), src)
    run()
    got = {(r.customer_id, str(r.day)): r.n_txn for r in EW.read_sink(spark, sink).collect()}
    assert got == {(1, "2024-01-01"): 1, (2, "2024-01-01"): 1, (1, "2024-01-02"): 1}  # the fifth may still grow
    SD.land(rows_of(spark, [(1, 3, "D", "2024-01-01T11:00"), (3, 4, "D", "2024-01-03T11:00"),
                            (1, 2, "C", "2024-01-04T12:00")]), src)
    run()
    EW.close_stream(spark, src, datetime(2024, 3, 1))
    run()
    run()  # nothing new: nothing leaves again
    got = {(r.customer_id, str(r.day)): (r.n_txn, r.volume, r.inflow, r.count_near_10k) for r in EW.read_sink(spark, sink).collect()}
    assert got == {(1, "2024-01-01"): (1, 9500, 9500, 1), (2, "2024-01-01"): (1, 5, 0, 0), (1, "2024-01-02"): (1, 7, 0, 0),
                   (1, "2024-01-04"): (1, 2, 2, 0), (1, "2024-01-05"): (1, 1, 1, 0)}
    SD.run_daily_flow(spark, src, arrived, str(tmp_path / "arrived-ckpt"))
    late = EW.late_rows(SD.windows(spark, arrived), EW.read_sink(spark, sink)).collect()
    assert sorted((r.customer_id, str(r.day), r.n_late, r.late_volume) for r in late) == [
        (1, "2024-01-01", 1, 3.0), (3, "2024-01-03", 1, 4.0)]


def test_alerts_leave_once_across_restarts(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("source", "sink", "ckpt"))
    days = [[(1, 9100, "C", "2024-01-01T20:00"), (1, 9999.99, "C", "2024-01-02T03:00"), (2, 9500, "C", "2024-01-01T20:00"),
             (3, 10000, "C", "2024-01-01T20:00"), (3, 8999.99, "D", "2024-01-01T21:00")],
            [(1, 9500, "D", "2024-01-02T19:00"), (2, 9500, "C", "2024-01-03T02:00"), (4, 9000, "D", "2024-01-03T09:00")],
            [(4, 9000, "D", "2024-01-03T09:00"), (9, 9000, "D", "2024-02-01T00:00")]]
    for rows in days:
        SD.land(rows_of(spark, rows), src)
        EW.run_alerts(spark, src, sink, ckpt, least=2)
    EW.close_stream(spark, src, datetime(2024, 6, 1))
    for _ in range(2):
        EW.run_alerts(spark, src, sink, ckpt, least=2)
    wall = EW.read_sink(spark, sink).select("customer_id", SD.utc_wall(F.col("first_time")).alias("t")).collect()
    assert sorted((r.customer_id, r.t) for r in wall) == [
        (1, datetime(2024, 1, 1, 20)), (1, datetime(2024, 1, 2, 3)), (4, datetime(2024, 1, 3, 9))]
