"""Reading real exports, and the job from exports to results."""

import pytest

from txnrisk.plans import queries as Q
from txnrisk.plans.job import export_inputs, run_job
from txnrisk.sources.channels import CHANNEL_SCHEMA
from txnrisk.sources.exports import KYC_INDIVIDUAL, read_export, read_exports

SF = "/root/testdata/sf0.001"


def lines(path, *rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def test_records_that_do_not_fit_are_set_aside(spark, tmp_path):
    path = lines(tmp_path / "card.csv", "customer_id,amount,debit_credit,transaction_datetime,note,ecommerce_ind",
                 '1,5.5,D,2024-01-01 10:00:00,"a, ""b""",1', "2,five,D,2024-01-01,x,0", "3,7,C,never,y,",
                 "4,8,C,2024-01-02,z,1,extra", "5,9,C", 'x,1,C,2024-01-02,z,0')
    good, bad = read_export(spark, path, CHANNEL_SCHEMA)
    assert [tuple(r) for r in good.select("customer_id", "amount", "transaction_datetime", "note", "ecommerce_ind")
            .orderBy("customer_id").collect()] == [
        (1, 5.5, "2024-01-01 10:00:00", 'a, "b"', 1), (3, 7.0, "never", "y", None)]
    assert sorted(r.record.split(",")[0] for r in bad.collect()) == ["2", "4", "5", "x"]
    # a scan of few columns sees the same records
    assert good.select("note").count() == 2 and good.count() == 2


def test_bad_dates_and_codes_are_no_reason(spark, tmp_path):
    path = lines(tmp_path / "kyc.csv", "customer_id,income,occupation_code,birth_date,onboard_date",
                 "1,10,n/a,1980-02-30,2020-01-01", "2,,41101,1980-02-03,")
    good, bad = read_export(spark, path, KYC_INDIVIDUAL)
    assert good.count() == 2 and bad.count() == 0


def test_missing_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_exports(spark, str(tmp_path))
    for name, header in (("kyc_individual", "customer_id,income"), ("kyc_smallbusiness", "customer_id,sales"),
                         ("kyc_occupation_codes", "occupation_code"), ("kyc_industry_codes", "industry_code")):
        lines(tmp_path / f"{name}.csv", header)
    with pytest.raises(FileNotFoundError):
        read_exports(spark, str(tmp_path))  # no channel
    lines(tmp_path / "wire.csv", "customer_id,amount_cad", "1,2")
    found = read_exports(spark, str(tmp_path))
    assert list(found.channels) == ["Wire"] and found.tables["labels"].count() == 0 and found.rejects.count() == 0


def test_job(spark, tmp_path):
    Q.write_exports(spark, SF, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    run_job(spark, str(tmp_path / "in"), out, as_of="2024-12-31", trees=8, min_cluster=1, restarts=2)
    read = {name: spark.read.parquet(f"{out}/{name}") for name in
            ("rejects", "features", "rules", "scores/all", "scores/high_risk", "labels", "evidence", "requests", "narratives")}
    inp, rejects = export_inputs(spark, str(tmp_path / "in"), "2024-12-31")
    n = inp.txn.select("customer_id").distinct().count()
    assert {name: df.count() for name, df in read.items()} | {"evidence": 0, "requests": 0, "narratives": 0,
                                                              "scores/high_risk": 0} == {
        "rejects": rejects.count(), "features": n, "rules": n, "scores/all": n, "labels": n, "evidence": 0,
        "requests": 0, "narratives": 0, "scores/high_risk": 0}
    assert read["requests"].count() == read["narratives"].count() == min(600, read["evidence"].count())
    assert spark.read.option("header", True).csv(f"{out}/explanations").count() == read["narratives"].count()
    assert rejects.where("source = 'kyc_individual'").count() == 1  # customer 5
    run_job(spark, str(tmp_path / "in"), out, as_of="2024-12-31", trees=8, min_cluster=1, restarts=2)  # replaces
    assert spark.read.parquet(f"{out}/features").count() == n
