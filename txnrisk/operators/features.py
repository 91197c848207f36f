"""Customer-level behavioural features.

Plan shape (per customer, all keyed on ``customer_id``):

* ``wide_aggregates`` - ONE ``groupBy(customer_id).agg`` with conditional
  counts/sums for volume, flow, structuring, channel pivot, card MCC groups,
  EFT/EMT, geography and time-of-day. Partial (map-side) aggregation means a
  customer holding a third of all rows still shuffles one row per map task.
* ``distinct_counts`` - each (customer, place) once in a narrow aggregate of
  its own, counted after that.
* ``daily`` + ``calendar_stats`` - (customer, date) pre-aggregate (one scan),
  then one chain to (customer, month) and customer. Active days and the
  longest gap between consecutive transactions come from it: a gap inside one
  date is < 24 h, so the longest gap in whole days is found between the last
  transaction of one active date and the first of the next. No window over a
  customer's raw rows (which AQE could not split for a hot customer). The
  monthly statistics roll up in the same chain.
* ``card_recency`` - per-customer last card timestamp, joined back to card
  rows on (customer, salt), so no task gets all rows of a hot customer, then a
  two-level conditional sum.

All blocks come out hash-partitioned on ``customer_id``, so the joins that
assemble them are sort-merge joins without further exchanges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import (
    bool_int,
    count_amount_if,
    count_if,
    elapsed_days,
    lit_d,
    safe_div,
    sum_if,
)

class _Cols:
    """Lazy column handles (a Column needs an active session)."""

    @property
    def amt(self) -> Column:
        return F.col("amount_cad")

    @property
    def hour(self) -> Column:
        return F.col("hour")

    @property
    def channel(self) -> Column:
        return F.col("channel")


_C = _Cols()


def is_night(hour: Column | None = None) -> Column:
    hour = F.col("hour") if hour is None else hour
    return (hour >= K.NIGHT_START_HOUR) | (hour <= K.NIGHT_END_HOUR)


def mcc_code() -> Column:
    """Merchant category as text, cut at the first '.' (``5411.0`` -> ``5411``)."""
    return F.split(F.trim(F.col("merchant_category").cast("string")), r"\.").getItem(0)


def mcc_in(codes: list[str]) -> Column:
    return F.col("_mcc").isin(codes)


def mcc_travel() -> Column:
    low, high = K.MCC_AIRLINE_RANGE  # airline carriers, as exact texts
    return mcc_in(K.MCC_TRAVEL) | mcc_in([str(code) for code in range(low, high + 1)])


def international() -> Column:
    """Not domestic; a NULL country counts as international (null-safe !=)."""
    return ~F.col("country").eqNullSafe(K.DOMESTIC_COUNTRY)


# ---------------------------------------------------------------------------
# Wide conditional aggregate
# ---------------------------------------------------------------------------

def volume_aggs() -> list[Column]:
    return [
        F.count(_C.amt).alias("transaction_count_total"),
        F.coalesce(F.sum(_C.amt), lit_d(0.0)).alias("total_volume"),
        F.avg(_C.amt).alias("avg_transaction_amount"),
        F.stddev_samp(_C.amt).alias("std_transaction_amount_raw"),
        F.min(_C.amt).alias("min_transaction_amount"),
        F.max(_C.amt).alias("max_transaction_amount"),
        F.min("transaction_datetime").alias("first_transaction_date"),
        F.max("transaction_datetime").alias("last_transaction_date"),
    ]


def flow_aggs() -> list[Column]:
    d = F.col("debit_credit") == "D"
    c = F.col("debit_credit") == "C"
    return [
        count_amount_if(d).alias("transaction_count_debit"),
        sum_if(d).alias("total_outflow"),
        count_amount_if(c).alias("transaction_count_credit"),
        sum_if(c).alias("total_inflow"),
    ]


def structuring_aggs() -> list[Column]:
    below = _C.amt < K.REPORTING_THRESHOLD
    return [
        count_if((_C.amt >= K.NEAR_THRESHOLD_LOW) & below).alias("count_near_10k"),
        count_if((_C.amt >= K.VERY_NEAR_THRESHOLD_LOW) & below).alias("count_very_near_10k"),
        count_amount_if(below).alias("count_below_10k"),
        sum_if(below).alias("sum_below_10k"),
        count_if(_C.amt % 100 == 0).alias("count_round_100"),
        count_if(_C.amt % 1000 == 0).alias("count_round_1000"),
        count_if((_C.channel == "ABM") & (F.col("cash_indicator") == 1) & below).alias("cash_struct_count"),
    ]


def channel_aggs() -> list[Column]:
    out = []
    for ch in K.CHANNELS:
        is_ch = _C.channel == ch
        low = ch.lower()
        out += [
            count_amount_if(is_ch).alias(f"count_{low}"),
            sum_if(is_ch).alias(f"sum_{low}"),
            F.coalesce(F.avg(F.when(is_ch, _C.amt)), lit_d(0.0)).alias(f"mean_{low}"),
            count_if(is_ch).alias(f"rows_{low}"),  # rows incl. NULL amounts (channel share)
        ]
    out.append(F.count(F.lit(1)).alias("rows_total"))
    return out


def card_aggs() -> list[Column]:
    card = _C.channel == "Card"
    return [
        count_amount_if(card & mcc_in(K.MCC_RETAIL)).alias("card_retail_count"),
        sum_if(card & mcc_in(K.MCC_RETAIL)).alias("card_retail_sum"),
        count_amount_if(card & mcc_in(K.MCC_LUXURY)).alias("card_luxury_count"),
        sum_if(card & mcc_in(K.MCC_LUXURY)).alias("card_luxury_sum"),
        count_amount_if(card & mcc_in(K.MCC_PARKING)).alias("card_parking_count"),
        count_amount_if(card & mcc_in(K.MCC_FOOD_DELIVERY)).alias("card_delivery_count"),
        count_amount_if(card & mcc_in(K.MCC_DIGITAL)).alias("card_digital_count"),
        sum_if(card & mcc_in(K.MCC_DIGITAL)).alias("card_digital_sum"),
        count_amount_if(card & mcc_in(K.MCC_ACCOMMODATION)).alias("card_accommodation_count"),
        sum_if(card & mcc_in(K.MCC_ACCOMMODATION)).alias("card_accommodation_sum"),
        count_amount_if(card & mcc_travel()).alias("card_travel_count"),
        sum_if(card & mcc_travel()).alias("card_travel_sum"),
        count_if(card & mcc_in(K.MCC_ADULT_SPA) & is_night()).alias("card_adult_afterhours_count"),
        count_if(card & is_night()).alias("card_afterhours_count"),
        count_amount_if(card & (F.col("ecommerce_ind") == 1)).alias("card_ecommerce_count"),
        sum_if(card & (F.col("ecommerce_ind") == 1)).alias("card_ecommerce_sum"),
    ]


def eft_emt_aggs() -> list[Column]:
    out = []
    for ch in ("EFT", "EMT"):
        for side, code in (("credit", "C"), ("debit", "D")):
            cond = (_C.channel == ch) & (F.col("debit_credit") == code)
            out += [count_amount_if(cond).alias(f"{ch.lower()}_{side}_count"),
                    sum_if(cond).alias(f"{ch.lower()}_{side}_sum")]
    return out


def geo_aggs() -> list[Column]:
    out = [
        count_amount_if(international()).alias("international_txn_count"),
        sum_if(international()).alias("international_txn_sum"),
    ]
    for name, countries in K.GEO_RISK_SETS:
        out.append(count_if(F.col("country").isin(countries)).alias(name))
    return out


def temporal_aggs() -> list[Column]:
    return [
        count_if(is_night()).alias("night_transaction_count"),
        count_if((_C.hour >= K.EVENING_START_HOUR) & (_C.hour <= K.EVENING_END_HOUR)).alias("evening_transaction_count"),
        count_if(F.col("day_of_week").isin(K.WEEKEND_DAYS)).alias("weekend_transaction_count"),
        count_if((_C.channel == "ABM") & is_night()).alias("night_abm_count"),
    ]


def wide_aggregates(txn: DataFrame) -> DataFrame:
    """One hash aggregate (whole-stage codegen: only count/sum/avg/min/max/
    stddev buffers; the median is computed separately) over a projection that
    evaluates the merchant category once per row."""
    aggs = (volume_aggs() + flow_aggs() + structuring_aggs() + channel_aggs() +
            card_aggs() + eft_emt_aggs() + geo_aggs() + temporal_aggs())
    return txn.withColumn("_mcc", mcc_code()).groupBy("customer_id").agg(*aggs)


# ---------------------------------------------------------------------------
# Side blocks
# ---------------------------------------------------------------------------

def distinct_counts(txn: DataFrame) -> DataFrame:
    """Each (customer, place) once, with whether a card transaction names it;
    then counts per customer. Three narrow rows a transaction, not the five
    wide ones of as many distinct counts."""
    kinds = ["country", "province", "city"]
    card = F.coalesce(_C.channel == "Card", F.lit(False))
    places = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("place")) for i, c in enumerate(kinds)])
    once = (txn.select("customer_id", card.alias("card"), F.explode(places).alias("x"))
               .groupBy("customer_id", "x.kind", "x.place").agg(F.max("card").alias("card")))

    def n(kind: str, also: Column | None = None) -> Column:
        is_kind = (F.col("kind") == kinds.index(kind)) & F.col("place").isNotNull()
        return count_if(is_kind if also is None else is_kind & also)

    return once.groupBy("customer_id").agg(
        n("country").alias("unique_countries"),
        n("province").alias("unique_provinces"),
        n("city").alias("unique_cities"),
        n("city", F.col("card")).alias("card_unique_cities"),
        n("country", F.col("card")).alias("card_unique_countries"),
    )


def daily(txn: DataFrame) -> DataFrame:
    """(customer, date) pre-aggregate: first/last timestamp, amount count and
    sum. Rows without a timestamp form one NULL-date group per customer."""
    return (txn.groupBy("customer_id", "date")
               .agg(F.min("transaction_datetime").alias("first_ts"),
                    F.max("transaction_datetime").alias("last_ts"),
                    F.count(_C.amt).alias("n_amount"),
                    F.sum(_C.amt).alias("sum_amount")))


def calendar_stats(days: DataFrame) -> DataFrame:
    """From the (customer, date) table, in one chain: the gap to the previous
    active date (window over at most one row per day), then per (customer,
    month) - 'NaT' for rows without a timestamp - then per customer: active
    days, the longest gap in whole days, and monthly count / volume std, mean
    and coefficient of variation."""
    from pyspark.sql import Window

    w = Window.partitionBy("customer_id").orderBy(F.col("date").asc_nulls_first())
    g = days.withColumn("gap", elapsed_days(F.col("first_ts"), F.lag("last_ts").over(w)))
    month = F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("NaT"))
    m = g.groupBy("customer_id", month.alias("year_month")).agg(
        F.count("date").alias("n_days"),
        F.max("gap").alias("max_gap"),
        F.sum("n_amount").alias("monthly_txn_count"),
        F.coalesce(F.sum("sum_amount"), lit_d(0.0)).alias("monthly_volume"))
    s = m.groupBy("customer_id").agg(
        F.sum("n_days").alias("active_days"),
        F.coalesce(F.max("max_gap"), F.lit(0).cast("long")).alias("max_days_between_txns"),
        F.stddev_samp(F.col("monthly_txn_count").cast("double")).alias("monthly_txn_count_std"),
        F.avg(F.col("monthly_txn_count").cast("double")).alias("monthly_txn_count_mean"),
        F.stddev_samp("monthly_volume").alias("monthly_volume_std"),
        F.avg("monthly_volume").alias("monthly_volume_mean"))
    return s.select(
        "customer_id", F.col("active_days").cast("long").alias("active_days"), "max_days_between_txns",
        F.coalesce("monthly_txn_count_std", lit_d(0.0)).alias("monthly_txn_count_std"),
        "monthly_txn_count_mean",
        F.coalesce("monthly_volume_std", lit_d(0.0)).alias("monthly_volume_std"),
        "monthly_volume_mean",
        F.coalesce(F.col("monthly_txn_count_std") / (F.col("monthly_txn_count_mean") + 1), lit_d(0.0))
         .alias("monthly_txn_cv"),
        F.coalesce(F.col("monthly_volume_std") / (F.col("monthly_volume_mean") + 1), lit_d(0.0))
         .alias("monthly_volume_cv"),
    )


RECENCY_SALTS = 16


def card_recency(txn: DataFrame) -> DataFrame:
    """Card volume within 30 / 90 whole days of each customer's own last card
    transaction. ``floor((last - ts) / 1 day) <= d``. Rows meet their
    customer's last date on (customer, salt), so that a customer with a large
    share of all rows is dealt to many tasks; the sums of the salts add up."""
    card = txn.where(_C.channel == "Card").select("customer_id", "transaction_datetime", "amount_cad")
    last = card.groupBy("customer_id").agg(F.max("transaction_datetime").alias("card_last_ts"))
    last = last.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(RECENCY_SALTS - 1))))
    salt = F.pmod(F.xxhash64("transaction_datetime", "amount_cad"), F.lit(RECENCY_SALTS)).cast("int")
    j = card.withColumn("salt", salt).join(last, ["customer_id", "salt"])
    days = elapsed_days(F.col("card_last_ts"), F.col("transaction_datetime"))
    names = [f"card_volume_{d}d" for d in K.CARD_RECENCY_WINDOWS]
    part = j.groupBy("customer_id", "salt").agg(*[
        sum_if(days <= d).alias(name) for d, name in zip(K.CARD_RECENCY_WINDOWS, names, strict=True)])
    return part.groupBy("customer_id").agg(*[F.sum(name).alias(name) for name in names])


# ---------------------------------------------------------------------------
# Assembly + projections after aggregation
# ---------------------------------------------------------------------------

def _hhi(ch_rows: list[str]) -> Column:
    total = F.col("rows_total").cast("double")
    terms = [F.pow(F.col(c) / total, 2) for c in ch_rows]
    s = terms[0]
    for t in terms[1:]:
        s = s + t
    return s


def behavioural_features(txn: DataFrame) -> DataFrame:
    """All transaction-derived features (Appendix A blocks 1-7), one row per
    customer. KYC, segment ratios, composites and imputation come later."""
    from .quantiles import grouped_median

    w = wide_aggregates(txn)
    blocks = [grouped_median(txn, "customer_id", "amount_cad", "median_transaction_amount"),
              distinct_counts(txn), calendar_stats(daily(txn)), card_recency(txn)]
    f = w
    for b in blocks:
        f = f.join(b, "customer_id", "left")

    n = F.col("transaction_count_total")
    span = F.col("time_span_days")
    std = F.coalesce(F.col("std_transaction_amount_raw"), lit_d(0.0))
    ch_rows = [f"rows_{c.lower()}" for c in K.CHANNELS]
    zero_fill = ["card_volume_30d", "card_volume_90d", "card_unique_cities", "card_unique_countries"]
    for c in zero_fill:
        f = f.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast(dict(f.dtypes)[c])))

    f = (f
         .withColumn("active_days", F.coalesce(F.col("active_days"), F.lit(0).cast("long")))
         .withColumn("max_days_between_txns", F.coalesce(F.col("max_days_between_txns"), F.lit(0).cast("long")))
         .withColumn("std_transaction_amount", std)
         .withColumn("net_flow", F.col("total_inflow") - F.col("total_outflow"))
         .withColumn("inflow_outflow_ratio", safe_div(F.col("total_inflow"), F.col("total_outflow") + 1))
         .withColumn("amount_cv", safe_div(std, F.col("avg_transaction_amount") + 1))
         .withColumn("time_span_days", elapsed_days(F.col("last_transaction_date"), F.col("first_transaction_date")) + 1)
         .withColumn("transactions_per_day", safe_div(n, span))
         .withColumn("transactions_per_active_day", safe_div(n, F.greatest(F.col("active_days"), F.lit(1))))
         .withColumn("volume_per_day", safe_div(F.col("total_volume"), span))
         .withColumn("inflow_per_day", safe_div(F.col("total_inflow"), span))
         .withColumn("outflow_per_day", safe_div(F.col("total_outflow"), span))
         .withColumn("flow_through_ratio",
                     safe_div(F.least(F.col("total_inflow"), F.col("total_outflow")), F.col("total_volume") / 2 + 1))
         .withColumn("ratio_below_10k", safe_div(F.col("count_below_10k"), n))
         .withColumn("ratio_round_100", safe_div(F.col("count_round_100"), n))
         .withColumn("ratio_round_1000", safe_div(F.col("count_round_1000"), n))
         .withColumn("unique_channels", sum(bool_int(F.col(c) > 0) for c in ch_rows).cast("long"))
         .withColumn("channel_diversity", F.col("unique_channels") / F.lit(float(len(K.CHANNELS))))
         .withColumn("channel_concentration_hhi", _hhi(ch_rows))
         .withColumn("has_western_union", bool_int(F.col("count_westernunion") > 0))
         .withColumn("has_wire", bool_int(F.col("count_wire") > 0))
         .withColumn("has_eft", bool_int(F.col("count_eft") > 0))
         .withColumn("has_emt", bool_int(F.col("count_emt") > 0))
         .withColumn("card_30d_ratio", F.coalesce(safe_div(F.col("card_volume_30d"), F.col("sum_card") + 1), lit_d(0.0)))
         .withColumn("card_90d_ratio", F.coalesce(safe_div(F.col("card_volume_90d"), F.col("sum_card") + 1), lit_d(0.0)))
         .withColumn("avg_txn_per_city", safe_div(n, F.col("unique_cities") + 0.1))
         .withColumn("avg_txn_per_province", safe_div(n, F.col("unique_provinces") + 0.1))
         .withColumn("international_ratio", safe_div(F.col("international_txn_count"), n))
         .withColumn("has_any_high_risk_txn", bool_int((F.col("drug_country_txn_count") > 0) |
                                                        (F.col("high_risk_fatf_txn_count") > 0) |
                                                        (F.col("offshore_center_txn_count") > 0)))
         .withColumn("night_transaction_ratio", safe_div(F.col("night_transaction_count"), n))
         .withColumn("evening_transaction_ratio", safe_div(F.col("evening_transaction_count"), n))
         .withColumn("weekend_ratio", safe_div(F.col("weekend_transaction_count"), n))
         )
    return f.select("customer_id", *BEHAVIOURAL_COLUMNS)


VOLUME_COLUMNS = [
    "transaction_count_total", "total_volume", "avg_transaction_amount", "median_transaction_amount",
    "std_transaction_amount", "min_transaction_amount", "max_transaction_amount",
    "first_transaction_date", "last_transaction_date", "active_days",
    "transaction_count_debit", "total_outflow", "transaction_count_credit", "total_inflow",
    "net_flow", "inflow_outflow_ratio", "amount_cv", "time_span_days", "max_days_between_txns",
    "transactions_per_day", "transactions_per_active_day", "volume_per_day", "inflow_per_day",
    "outflow_per_day", "flow_through_ratio",
]
STRUCTURING_COLUMNS = [
    "count_near_10k", "count_very_near_10k", "count_below_10k", "sum_below_10k",
    "count_round_100", "count_round_1000", "ratio_below_10k", "ratio_round_100",
    "ratio_round_1000", "cash_struct_count",
]
CHANNEL_COLUMNS = (
    [f"count_{c.lower()}" for c in K.CHANNELS] + [f"sum_{c.lower()}" for c in K.CHANNELS] +
    [f"mean_{c.lower()}" for c in K.CHANNELS] +
    ["unique_channels", "channel_diversity", "channel_concentration_hhi",
     "has_western_union", "has_wire", "has_eft", "has_emt"]
)
CARD_COLUMNS = [
    "card_retail_count", "card_retail_sum", "card_luxury_count", "card_luxury_sum",
    "card_parking_count", "card_delivery_count", "card_digital_count", "card_digital_sum",
    "card_accommodation_count", "card_accommodation_sum", "card_travel_count", "card_travel_sum",
    "card_adult_afterhours_count", "card_afterhours_count", "card_ecommerce_count",
    "card_ecommerce_sum", "card_unique_cities", "card_unique_countries", "card_volume_30d",
    "card_volume_90d", "card_30d_ratio", "card_90d_ratio",
]
EFT_EMT_COLUMNS = [
    "eft_credit_count", "eft_credit_sum", "eft_debit_count", "eft_debit_sum",
    "emt_credit_count", "emt_credit_sum", "emt_debit_count", "emt_debit_sum",
]
GEO_COLUMNS = [
    "unique_countries", "unique_provinces", "unique_cities", "avg_txn_per_city",
    "avg_txn_per_province", "international_txn_count", "international_txn_sum",
    "international_ratio", "drug_country_txn_count", "high_risk_fatf_txn_count",
    "greylist_txn_count", "offshore_center_txn_count", "underground_banking_country_count",
    "ht_source_country_txn_count", "has_any_high_risk_txn",
]
TEMPORAL_COLUMNS = [
    "night_transaction_count", "evening_transaction_count", "weekend_transaction_count",
    "night_transaction_ratio", "evening_transaction_ratio", "weekend_ratio", "night_abm_count",
    "monthly_txn_count_std", "monthly_txn_count_mean", "monthly_volume_std",
    "monthly_volume_mean", "monthly_txn_cv", "monthly_volume_cv",
]
BEHAVIOURAL_COLUMNS = (VOLUME_COLUMNS + STRUCTURING_COLUMNS + CHANNEL_COLUMNS + CARD_COLUMNS +
                       EFT_EMT_COLUMNS + GEO_COLUMNS + TEMPORAL_COLUMNS)

