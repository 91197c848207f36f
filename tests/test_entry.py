"""The driver contract: entry() runs on sf0.001 with a stable schema, and
every oracle key is a registered query."""


def test_entry_schema(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.schema.simpleString() == (
        "struct<customer_id:bigint,rule_score_weighted:double,rules_triggered:int,"
        "primary_rule_typology:string,rule_indicator_trace:string>")
    assert df.count() > 0


def test_oracle_keys_are_queries():
    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 64 and "flagship" not in q
