"""Money expressions. Money is decimal everywhere; doubles appear only where statistics need them."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

from tallystone.functions.rules import AMOUNT_BUCKETS, MONEY, TOP_BUCKET


def clean_amount(raw: Column) -> Column:
    """Text to decimal(18,2), half-up; ``$`` and ``,`` ignored, anything unreadable is NULL.

    ``try_cast`` keeps this independent of the session's ANSI setting.
    """
    return F.translate(raw, "$,", "").try_cast(MONEY)


def amount_num(amount: Column) -> Column:
    """Amount as double, for statistics."""
    return amount.cast("double")


def amount_bucket(
    amount: Column, buckets: Sequence[tuple[float, str]] = AMOUNT_BUCKETS, top: str = TOP_BUCKET
) -> Column:
    """Label of the half-open size class an amount falls into."""
    label = F
    for limit, name in buckets:
        label = label.when(amount < limit, name)
    return label.otherwise(top)


def exact_average(total: Column, count: Column) -> Column:
    """``total / count`` in decimal(18,2), rounded half away from zero on whole cents; NULL for no rows.

    A double average cast to decimal is off by a cent on half-cent ties, so the division is done on
    integers: (2 * |cents| + n) div (2 * n), with the total's sign.
    """
    cents = (total.cast(MONEY) * 100).cast("bigint")
    count = F.nullif(count.cast("bigint"), F.lit(0).cast("bigint"))
    rounded_cents = F.call_function("div", F.abs(cents) * 2 + count, count * 2) * F.signum(cents).cast("bigint")
    return (rounded_cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)
