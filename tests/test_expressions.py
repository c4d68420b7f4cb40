"""Exact decimals and calendar parsing, one case per rule boundary."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from crosstally.functions import decimals as dec, times


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def value(spark, text, dtype):
    return F.lit(text).cast(dtype)


def test_conversion_keeps_18_fractional_digits(spark):
    amount, rate = F.lit("1234567890.12345678").cast(dec.MONEY), F.lit("1.0000000001").cast(dec.RATE)
    df = spark.range(1).select(dec.convert(amount, rate).alias("v"))
    assert df.schema["v"].dataType == dec.USD
    assert df.first()["v"] == D("1234567890.12345678") * D("1.0000000001")


def test_sum_times_rate_keeps_scale(spark):
    rows = spark.createDataFrame([(D("0.12345678"),), (D("0.00000001"),)], "a decimal(20,8)")
    total = rows.agg(F.sum("a").alias("a")).select(dec.convert("a", F.lit("1.1234567891").cast(dec.RATE)).alias("v"))
    assert total.first()["v"] == D("0.12345679") * D("1.1234567891")


def test_difference_keeps_the_last_digit(spark):
    a, b = F.lit("1.000000000000000001").cast(dec.USD), F.lit("0.000000000000000002").cast(dec.USD)
    df = spark.range(1).select(dec.minus(a, b).alias("v"))
    assert df.schema["v"].dataType == dec.USD
    assert df.first()["v"] == D("0.999999999999999999")


@pytest.mark.parametrize("text, cents", [("0.125", "0.13"), ("-0.125", "-0.13"), ("0.1249", "0.12")])
def test_cents_round_half_away_from_zero(spark, text, cents):
    assert one(spark, dec.cents(F.lit(text).cast(dec.USD))) == D(cents)


def fee(spark, principal, percent, fixed="0", **how):
    args = F.lit(principal).cast(dec.MONEY), F.lit(percent).cast(dec.RATE), F.lit(fixed).cast(dec.MONEY)
    return one(spark, dec.percent_fee(*args, **how))


def test_percent_fee_is_exact_at_half_cents(spark):
    assert fee(spark, "40.20", "2.5") == D("1.01")
    assert fee(spark, "40.20", "2.5", rounding="float") == D("1.00")
    assert fee(spark, "24.99", "2.5") == fee(spark, "24.99", "2.5", rounding="float") == D("0.62")
    assert fee(spark, "100", "1.75", "0.30") == D("2.05")


@pytest.mark.parametrize(
    "amount, rate",
    [("1000", "12345678.5"), ("-0.00000001", "99999999.9999999999"), ("123.45678901", "0.0000000001"), ("7", "-2.5")],
)
def test_convert_takes_every_rate(spark, amount, rate):
    value = one(spark, dec.convert(F.lit(D(amount)), F.lit(D(rate)).cast(dec.RATE)))
    assert value == D(amount) * D(rate)


@pytest.mark.parametrize(
    "principal, percent, fee",
    [
        ("2000000000", "2.5", "50000000.00"),
        ("100000000", "2.123456789", "2123456.79"),
        ("0.999999999999999999", "50", "0.50"),
        ("99999999999.995000000000000001", "1", "1000000000.00"),
        ("1.000000000000000000", "0.5", "0.01"),
        ("0.999999999999999999", "0.5", "0.00"),
    ],
)
def test_wide_fees_are_exact(spark, principal, percent, fee):
    usd = F.lit(D(principal)).cast(dec.USD)
    args = F.lit(D(percent)).cast(dec.RATE), F.lit(D(0)).cast(dec.MONEY)
    assert one(spark, dec.percent_fee(usd, *args, wide=True)) == D(fee)


def test_percent_fee_of_a_converted_amount(spark):
    usd = F.lit("40.200000000000000000").cast(dec.USD)
    args = F.lit("2.5").cast(dec.RATE), F.lit("0").cast(dec.MONEY)
    assert one(spark, dec.percent_fee(usd, *args, wide=True)) == D("1.01")


def test_percent_fee_matches_decimal_arithmetic_everywhere(spark):
    """All amounts 0.01 to 1999.99 at 2.5 percent."""
    amounts = spark.range(1, 200000).select((F.col("id").cast("decimal(20,8)") * F.lit(D("0.01"))).alias("a"))
    priced = amounts.select("a", dec.percent_fee(F.col("a"), F.lit("2.5").cast(dec.RATE), F.lit("0").cast(dec.MONEY)).alias("f"))
    # half a cent is 0.2 in units of the amount at 2.5 percent: compare in integers
    wrong = priced.filter("cast(f * 100 as bigint) <> floor((cast(a * 100 as bigint) * 25 + 500) / 1000)")
    assert wrong.count() == 0


@pytest.mark.parametrize(
    "amount, exponent, major",
    [
        ("1234", "0", "1234"), ("1234", "2", "12.34"), ("1", "8", "0.00000001"), ("-5", "3", "-0.005"),
        ("1234", "9", None), ("1234", "-1", None), ("1234", "x", None), ("1234", "", None), ("1234", None, None),
        ("abc", "2", None), (None, "2", None),
    ],
)
def test_minor_to_major(spark, amount, exponent, major):
    got = one(spark, dec.minor_to_major(F.lit(amount).cast("string"), F.lit(exponent).cast("string")))
    assert got == (None if major is None else D(major))


@pytest.mark.parametrize("text, number", [("1.10", "1.1"), ("", None), ("1,234.5", None), ("1.123456785", "1.12345679")])
def test_tolerant_cast(spark, text, number):
    assert one(spark, dec.tolerant(F.lit(text))) == (None if number is None else D(number))


@pytest.mark.parametrize("text, number", [("59,99", "59.99"), ("-0,5", "-0.5"), ("1.234,50", None), ("12", "12")])
def test_decimal_comma(spark, text, number):
    assert one(spark, dec.decimal_comma(F.lit(text))) == (None if number is None else D(number))


def test_inverted_rate(spark):
    assert one(spark, dec.invert_rate(F.lit("4").cast(dec.RATE))) == D("0.25")
    assert one(spark, dec.invert_rate(F.lit("0").cast(dec.RATE))) is None


def utc(spark, text, zone, pattern=times.MONTH_FIRST):
    stamp = one(spark, times.iso_z(times.to_utc(times.local_clock(F.lit(text), pattern), F.lit(zone).cast("string"))))
    return stamp


def test_calendar_is_checked(spark):
    assert utc(spark, "06/31/2026 10:00:00", "UTC") is None
    assert utc(spark, "02/29/2024 10:00:00", "UTC") == "2024-02-29T10:00:00Z"
    assert utc(spark, "6/1/2026 9:05:07", "UTC") == "2026-06-01T09:05:07Z"


@pytest.mark.parametrize(
    "zone, expected",
    [
        ("UTC", "2026-07-01T12:00:00Z"),
        ("PST", "2026-07-01T19:00:00Z"),
        ("CET", "2026-07-01T10:00:00Z"),
        ("EST", "2026-07-01T17:00:00Z"),
        ("America/Sao_Paulo", "2026-07-01T15:00:00Z"),
        ("PDT", None),
        ("CEST", None),
        ("BST", None),
        ("Mars/Olympus", None),
        ("", None),
        (None, None),
    ],
)
def test_zone_tokens(spark, zone, expected):
    assert utc(spark, "07/01/2026 12:00:00", zone) == expected


def test_daylight_gap_and_overlap(spark):
    assert utc(spark, "03/08/2026 02:30:00", "America/Los_Angeles") == "2026-03-08T10:30:00Z"
    # the hour that occurs twice is read as its first occurrence
    assert utc(spark, "11/01/2026 01:30:00", "America/Los_Angeles") == "2026-11-01T08:30:00Z"


def test_every_allowed_region_is_known_to_the_engine(spark):
    regions = spark.createDataFrame([(r,) for r in times.region_names()], "zone string")
    clock = F.lit("2026-07-01 00:00:00").cast("timestamp")
    assert regions.select(times.to_utc(clock, F.col("zone")).alias("u")).filter("u IS NULL").count() == 0


@pytest.mark.parametrize(
    "text, expected",
    [
        ("03/06/2026", "2026-06-03"),  # both readings lie in the interval: day first
        ("06/20/2026", "2026-06-20"),  # only month first exists
        ("07/05/2026", None),  # neither reading lies in the interval
        ("06/04/2026", "2026-06-04"),  # day first is April, outside; month first is June
        ("31/06/2026", None),
    ],
)
def test_day_order_follows_the_declared_interval(spark, text, expected):
    first, last = times.interval_of_file(F.lit("file:/in/x_20260601_20260703.csv"))
    got = one(spark, times.day_or_month_first(F.lit(text + " 01:02:03"), first, last).cast("date"))
    assert (got and got.isoformat()) == expected


def test_file_without_interval_resolves_nothing(spark):
    first, last = times.interval_of_file(F.lit("file:/in/x.csv"))
    assert one(spark, times.day_or_month_first(F.lit("03/06/2026 01:02:03"), first, last)) is None
