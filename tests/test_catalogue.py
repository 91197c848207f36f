from pyspark.sql import functions as F

from txnrisk import constants as K
from txnrisk.operators import catalogue as CA
from txnrisk.operators import rules as R


def test_catalogue_shape(spark):
    cat = CA.catalogue(spark)
    per = {r["typology"]: r["count"] for r in cat.groupBy("typology").count().collect()}
    assert per == {"structuring_layering": 8, "behavioural_profile": 11, "trade_shell": 6,
                   "cross_border_geo": 7, "human_trafficking": 12}
    risk = {r["risk_level"]: r["count"] for r in cat.groupBy("risk_level").count().collect()}
    assert risk == {"High": 24, "Medium": 17, "Low": 3}
    e = CA.cooccurrence_edges(cat)
    assert e.count() == 136
    assert e.where("has_reverse = 1").count() == 88
    assert e.where("dst_in_catalogue = 0").count() == 0


def test_rules_vs_catalogue():
    rule_ids = {i for _, _, i in R.indicator_ids()}
    cat_ids = {r[0] for r in K.CATALOGUE}
    assert len(rule_ids) == 42
    assert rule_ids <= cat_ids
    assert cat_ids - rule_ids == {"ATYPICAL-008", "PROF-003"}


def test_read_catalogue_csv(spark, tmp_path):
    p = tmp_path / "cat.csv"
    p.write_text(
        "﻿Indicator Id,Indicator Category,Sub Category,Red Flag Description,Risk Level,Typology,"
        "Geographic Focus,Transaction Type,Co Occurring Indicators,Source Primary,Source Url,Date Published,Notes\n"
        "  BANNER (2 indicators),,,,,,,,,,,,\n"
        'A-1,Cat,Sub,"Desc, with comma",High,T,All,"ABM, Card","B-2",,,,\n'
        'B-2,Cat,Sub,"Line\nbreak",Low,T,All,Wire,"A-1",,,,\n', encoding="utf-8")
    df = CA.read_catalogue_csv(spark, str(p))
    rows = {r["indicator_id"]: r for r in df.collect()}
    assert set(rows) == {"A-1", "B-2"}
    assert rows["A-1"]["transaction_type"] == ["ABM", "Card"]
    _ = F


def test_mcc_descriptions(spark):
    rows = [("5411",), ("3000",), ("3005",), ("3299",), ("3300",), ("3501",), ("3999",), ("x",), (None,), ("3351",), ("5411",)]
    df = spark.createDataFrame(rows, "mcc string")
    wide = CA.mcc_intervals(spark).union(spark.createDataFrame([(3005, 3005, "One carrier")], "low int, high int, description string"))
    got = sorted(((repr(r.mcc), r.description) for r in CA.with_mcc_description(df, wide).collect()), key=repr)
    airline = "Airlines (General Category)"
    assert got == sorted([("'5411'", "Grocery Stores, Supermarkets")] * 2 + [
        ("'3000'", airline), ("'3005'", "One carrier"), ("'3299'", airline), ("'3300'", None),
        ("'3501'", "Hotels, Motels, Resorts"), ("'3999'", "Hotels, Motels, Resorts"), ("'x'", None), ("None", None),
        ("'3351'", "Car Rental Agencies")], key=repr)


def test_catalogue_export_has_mark_and_banners(spark, tmp_path):
    path = str(tmp_path / "cat")
    CA.write_catalogue_csv(spark, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 1 + 5 + 44 and sum("▌" in x for x in lines) == 5
    raw = b"".join(p.read_bytes() for p in (tmp_path / "cat").glob("part-*"))
    assert raw.startswith(b"\xef\xbb\xbfIndicator Id,")
    back = {r.indicator_id: r for r in CA.read_catalogue_csv(spark, path).collect()}
    assert sorted(back) == sorted(r[0] for r in K.CATALOGUE)
    assert all(back[r[0]].risk_level == r[3] for r in K.CATALOGUE)
