"""Contracted fees against reported fees."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crosstally.functions.decimals import MONEY, RATE, USD, cents, convert, minus, percent_fee
from crosstally.operators.asof import contract_in_force
from crosstally.operators.reconcile import in_month

_EVENT_KEY = ["psp", "provider_event_id", "provider_account"]


def link_unique(
    rows: DataFrame, targets: DataFrame, on: Sequence[tuple[str, str]], target_id: str, alias: str
) -> DataFrame:
    """Give each row the ID of its target if the attribute group holds one row and one target.

    All rows stay; ambiguous or lonely ones get a NULL link. Both sides are counted per
    group in one shuffle before the link is joined back, so a large group of equal rows
    is never gathered.
    """
    keys = [f"_k{i}" for i in range(len(on))]

    def tagged(df: DataFrame, columns: Sequence[str], link: Column, side: str) -> DataFrame:
        picked = (F.col(c).alias(k) for c, k in zip(columns, keys))
        return df.select(*picked, link.alias("_link"), F.lit(side).alias("_side"))

    both = tagged(rows, [r for r, _ in on], F.lit(None).cast("string"), "row").unionByName(
        tagged(targets, [t for _, t in on], F.col(target_id), "target")
    )
    groups = both.dropna(subset=keys).groupBy(*keys)
    links = (
        groups.agg(
            F.count_if(F.col("_side") == "row").alias("_rows"),
            F.count_if(F.col("_side") == "target").alias("_targets"),
            F.min("_link").alias(alias),
        )
        .filter("_rows = 1 AND _targets = 1")
        .select(*keys, alias)
    )
    keyed = rows.select("*", *(F.col(r).alias(k) for (r, _), k in zip(on, keys)))
    # A linked group has one row, so no link can be hot.
    return keyed.join(links, keys, "left").select(*rows.columns, alias)


def reported_fees(fees: DataFrame) -> DataFrame:
    """Sum of the fee components per event and currency."""
    return fees.groupBy(*_EVENT_KEY, F.col("currency").alias("fee_currency")).agg(
        F.sum("fee_amount").cast(MONEY).alias("reported_fee_local")
    )


def fee_scope(events: DataFrame, tariffs: DataFrame, months: Sequence[date]) -> DataFrame:
    """Settled financial sales of the report months that a tariff covers."""
    in_scope = reduce(
        Column.__or__, (in_month("event_timestamp_utc", F.lit(m).cast("date")) for m in months)
    )
    sales = events.filter("operation_type = 'SALE' AND status = 'settled' AND is_financial_event").filter(in_scope)
    covered = contract_in_force(sales, tariffs)
    return covered.select(
        F.trunc("event_timestamp_utc", "MM").alias("report_month"),
        *_EVENT_KEY,
        "event_timestamp_utc",
        F.col("currency").alias("principal_currency"),
        F.col("amount_local_signed").alias("principal_amount_local"),
        F.col("amount_usd_normalized").alias("principal_amount_usd"),
        "fx_rate_selected",
        F.col("valid_from").alias("contract_valid_from"),
        "percent_fee",
        "fixed_fee",
        "fixed_fee_currency",
    )


def price(contracted: DataFrame, reported: DataFrame, rounding: str = "exact") -> DataFrame:
    """Value each contracted sale in its fee currency and compute the fee it should carry.

    A sale without a reported fee keeps NULLs. The expected fee is NULL where a fixed
    part is due in a currency other than the fee's.
    """
    joined = contracted.join(reported, _EVENT_KEY, "left")
    same = F.col("fee_currency") == F.col("principal_currency")
    in_usd = F.col("fee_currency") == "USD"
    local, usd = F.abs("principal_amount_local"), F.abs("principal_amount_usd")
    percent, fixed = F.col("percent_fee"), F.col("fixed_fee")
    payable = (fixed == 0) | (F.col("fixed_fee_currency") == F.col("fee_currency"))
    expected = F.when(same, percent_fee(local, percent, fixed, rounding=rounding)).when(
        in_usd, percent_fee(usd, percent, fixed, wide=True, rounding=rounding)
    )
    return joined.withColumns(
        {
            "principal_amount_fee_currency": F.when(same, local.cast(USD)).when(in_usd, usd),
            "fee_fx_rate": F.when(same, F.col("fx_rate_selected")).when(in_usd, F.lit(1).cast(RATE)),
            "expected_fee_local": F.when(payable, expected),
        }
    )


def fee_variance(priced: DataFrame) -> DataFrame:
    """Reported minus expected, locally and in USD cents; an unknown comparison differs."""
    reported, expected = F.col("reported_fee_local"), F.col("expected_fee_local")
    measured = priced.withColumns(
        {
            "signed_fee_variance_local": (reported - expected).cast(MONEY),
            "reported_fee_usd": cents(convert(reported, "fee_fx_rate")).cast(USD),
            "expected_fee_usd": cents(convert(expected, "fee_fx_rate")).cast(USD),
            "cause": F.when(reported == expected, "matched").otherwise("fee_difference"),
        }
    )
    variance = minus("reported_fee_usd", "expected_fee_usd")
    return measured.withColumns({"signed_fee_variance_usd": variance, "absolute_fee_variance_usd": F.abs(variance)})


def reconcile_fees(
    events: DataFrame, fees: DataFrame, tariffs: DataFrame, months: Sequence[date], rounding: str = "exact"
) -> DataFrame:
    """Fee detail of the report months, one row per contracted sale and fee currency."""
    return fee_variance(price(fee_scope(events, tariffs, months), reported_fees(fees), rounding))


def summarise_fees(detail: DataFrame) -> DataFrame:
    """Totals per month, provider, account, fee currency and cause."""
    sums = (
        "reported_fee_local",
        "expected_fee_local",
        "signed_fee_variance_local",
        "reported_fee_usd",
        "expected_fee_usd",
        "signed_fee_variance_usd",
        "absolute_fee_variance_usd",
    )
    return detail.groupBy("report_month", "psp", "provider_account", "fee_currency", "cause").agg(
        F.count(F.lit(1)).alias("event_count"), *(F.sum(c).alias(c) for c in sums)
    )
