"""Turnover within 24 hours against a walk over each customer's events."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from txnrisk.operators.extras import same_day_turnover

SCHEMA = "customer_id long, amount_cad double, debit_credit string, transaction_datetime timestamp_ntz"


def walk(rows):
    credits, used = defaultdict(float), defaultdict(lambda: [0, 0.0])
    for c, a, d, t in rows:
        if t and a and a > 0 and d == "C":
            credits[c, t] += a
    for c, a, d, t in rows:
        if t and a and a > 0 and d == "D":
            before = max((k[1] for k in credits if k[0] == c and k[1] <= t), default=None)
            if before and t - before <= timedelta(hours=24):
                used[c, before][0] += 1
                used[c, before][1] += a
    return {k: (v, used[k][0], used[k][1], min(v, used[k][1])) for k, v in credits.items()}


def test_random_events(spark):
    rng = random.Random(4)
    start = datetime(2024, 2, 28)
    rows = [(rng.randrange(4), rng.choice([None, 0.0, 5.0, 8.0, 100.0]), rng.choice(["C", "D", "D", None]),
             start + timedelta(hours=rng.randrange(24 * 20))) for _ in range(600)]
    rows += [(9, 4.0, "C", None), (9, 4.0, "C", start), (9, 3.0, "D", start + timedelta(hours=24)),
             (9, 2.0, "D", start + timedelta(hours=24, seconds=1)), (9, 1.0, "D", start)]
    got = {(r.customer_id, r.transaction_datetime): (r.credit, r.n_debits, r.debit_24h, r.turnover)
           for r in same_day_turnover(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == walk(rows)
    assert got[9, start] == (4.0, 2, 4.0, 4.0)


def test_empty(spark):
    assert same_day_turnover(spark.createDataFrame([], SCHEMA)).collect() == []
