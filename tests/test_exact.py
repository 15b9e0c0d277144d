"""Rounding once, on the exact value."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.functions.money import dollars, quotient, resummed
from spendlens.operators import anomaly, attribution
from tests.util import CALL, SQL_CALL, cr, ts


def test_half_cents_of_sums_of_sums(spark):
    calls = spark.createDataFrame(
        [("q", 1, "AI_FILTER", None, cr("0.001666666"), ts("2024-01-30 01:00:00"), None)], CALL)
    users = spark.createDataFrame([(1, "a")], "user_id bigint, name string")
    (row,) = attribution.spend_by_user(calls, users, "2024-01-31").collect()
    assert row.est_dollars == 0.0  # 0.004999998 dollars


def test_percent_next_to_a_cut(spark):
    usage = spark.createDataFrame(
        [("a", 1, "m", "f", 1, cr("0.499499996"), "team=x", ts("2024-01-30 01:00:00")),
         ("b", 1, "m", "f", 1, cr("0.500500004"), None, ts("2024-01-30 01:00:00"))], SQL_CALL)
    got = {r.attribution: (r.pct_of_total, r.grade) for r in attribution.tag_coverage(usage, "2024-01-31").collect()}
    assert got == {"Tagged": (49.9, "bad"), "Untagged": (50.1, "bad")}


def test_multiplier_of_tiny_spend(spark):
    days = ("2024-01-02", "2024-01-09", "2024-01-16", "2024-01-23")
    calls = [("q", 1, "f", None, cr("0.0000004"), ts(f"{d} 01:00:00"), None) for d in days]
    calls.append(("q", 1, "f", None, cr("0.0000013"), ts("2024-01-30 01:00:00"), None))
    users = spark.createDataFrame([(1, "a")], "user_id bigint, name string")
    (row,) = anomaly.user_weekly_spike(spark.createDataFrame(calls, CALL), users, "2024-01-31").collect()
    assert row.multiplier == 3.3  # exactly 3.25


@pytest.mark.parametrize(
    ("n", "d", "digits", "times", "want"),
    [("1", "3", 1, 100, "33.3"), ("-1", "8", 2, 1, "-0.13"), ("0.000000001", "2", 0, 1, "0"), ("1", "0", 1, 1, None),
     ("0.005", "1", 2, 1, "0.01"), ("-2", "-3", 1, 100, "66.7"), (None, "1", 1, 1, None)])
def test_quotient(spark, n, d, digits, times, want):
    row = spark.range(1).select(
        quotient(F.lit(n).cast("decimal(18,9)"), F.lit(d).cast("decimal(18,9)"), digits, times).alias("q")).first()
    assert (row.q is None) if want is None else row.q == Decimal(want)


def test_sum_of_sums_keeps_its_type(spark):
    df = spark.range(3).selectExpr("id", "CAST(0.000000001 AS decimal(18,9)) AS c")
    twice = df.groupBy("id").agg(F.sum("c").alias("c")).agg(resummed("c").alias("c"))
    assert twice.schema["c"].dataType.simpleString() == "decimal(28,9)"
    assert twice.select(dollars(F.col("c"), digits=4)).first()[0] == 0.0
