"""Column-expression helpers. All of them compile to built-in Catalyst
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import struct
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import RISK_BAND_FLOOR, RISK_BANDS

MICROS_PER_DAY = 86_400_000_000


def lit_d(x: float) -> Column:
    """Double literal (keeps IEEE arithmetic; a bare 0.25 would be DECIMAL in SQL)."""
    return F.lit(float(x)).cast("double")




SMALLEST_NORMAL = 2.0 ** -1022


def sort_key(v: Column) -> Column:
    """A double as a 64-bit integer of the same order: the bits of its size
    (exponent and fraction), negative for negative numbers; both zeros are 0.
    All steps are exact: powers of two, and a logarithm corrected by them."""
    size = F.abs(v)
    guess = F.floor(F.log2(size)).cast("double")
    power = F.pow(lit_d(2.0), guess)
    exponent = F.when(power > size, guess - 1).when(power * 2 <= size, guess + 1).otherwise(guess)
    fraction = (size / F.pow(lit_d(2.0), exponent) - 1) * lit_d(2.0 ** 52)
    bits = (F.when(size < lit_d(SMALLEST_NORMAL), (size * lit_d(2.0 ** 537) * lit_d(2.0 ** 537)).cast("long"))
             .when(size == lit_d(float("inf")), F.lit(2047 << 52))
             .otherwise((exponent + 1023).cast("long") * F.lit(1 << 52) + fraction.cast("long")))
    return F.when(v < 0, -bits).otherwise(bits)


def from_sort_key(key: int) -> float:
    value = struct.unpack(">d", struct.pack(">q", abs(key)))[0]
    return -value if key < 0 else value


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true (nulls count as false)."""
    return F.count(F.when(cond, F.lit(1)))


def count_amount_if(cond: Column, amount: str = "amount_cad") -> Column:
    """Non-null amounts where ``cond`` holds (pandas ``count`` semantics)."""
    return F.count(F.when(cond, F.col(amount)))


def sum_if(cond: Column, amount: str = "amount_cad") -> Column:
    """Sum of amounts where ``cond`` holds; 0 when nothing qualifies."""
    return F.coalesce(F.sum(F.when(cond, F.col(amount))), lit_d(0.0))


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps (floor), not calendar days."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")


def risk_band(score: Column) -> Column:
    expr = None
    for lo, label in RISK_BANDS:
        expr = F.when(score >= lo, label) if expr is None else expr.when(score >= lo, label)
    return expr.otherwise(RISK_BAND_FLOOR)


def argmax_label(cols: Sequence[str], labels: Sequence[str]) -> Column:
    """Label of the first column holding the row maximum (first wins on ties).
    NULL values are skipped like pandas idxmax."""
    top = F.greatest(*[F.col(c) for c in cols])
    expr = None
    for c, lab in zip(cols, labels):
        cond = F.col(c) == top
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bool_int(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
