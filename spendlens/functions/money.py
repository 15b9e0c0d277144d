"""Credit arithmetic. Credits stay DECIMAL until the output column, so sums do
not depend on row order and rounding is half-up on the exact value."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

CREDITS = "decimal(18,9)"

#: Type of a sum of credits.
TOTALS = "decimal(28,9)"

#: Estimated price of one credit in dollars.
PRICE_PER_CREDIT = 3


def dec(value: int | float | str | Decimal) -> Column:
    """An exact decimal literal."""
    return F.lit(Decimal(str(value)))


def credit(name: str) -> Column:
    return F.col(name).cast(CREDITS)


def total(name: str) -> Column:
    return F.sum(credit(name))


def resummed(name: str) -> Column:
    """The sum of sums, back in the type of a plain sum: later products stay exact."""
    return F.sum(name).cast(TOTALS)


def quotient(numerator: Column, denominator: Column, digits: int, times: int = 1) -> Column:
    """``times * numerator / denominator``, rounded half-up once, on the exact value.

    Spark cuts a decimal quotient to the digits that fit and would round it a
    second time. Here whole numbers decide. NULL where the denominator is zero.
    """
    n, d = numerator.cast("decimal(30,9)"), denominator.cast(TOTALS)
    doubled = F.abs(n) * dec(2 * times * 10**digits) + F.abs(d)
    whole = F.call_function("div", doubled, F.abs(d) * dec(2))
    signed = F.when((n < 0) != (d < 0), -whole).otherwise(whole)
    return F.when(d != 0, signed.cast("decimal(20,0)") * dec(Decimal(1).scaleb(-digits)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact division; NULL where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def rounded(value: Column, digits: int) -> Column:
    return F.round(value, digits).cast("double")


def dollars(credits: Column, price: float = PRICE_PER_CREDIT, digits: int = 2) -> Column:
    return rounded(credits * dec(price), digits)


def mean(sum_: Column, count: Column) -> Column:
    """Unrounded average as DOUBLE: the exact sum over the count."""
    return F.try_divide(sum_.cast("double"), count.cast("double"))


def per_million(credits: Column, tokens: Column) -> Column:
    """Credits per one million tokens, exact."""
    return ratio(credits * dec(1_000_000), tokens)
