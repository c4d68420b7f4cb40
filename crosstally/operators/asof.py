"""Reference data in force on a date: latest revision, as-of join, valuation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crosstally.functions.decimals import RATE, convert
from crosstally.operators.contracts import VALUED_EVENT, conform


def latest_revision(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The newest row per key; a tie is settled by the remaining columns.

    An aggregate rather than a ranking window: each task keeps one candidate per key,
    so a key with very many revisions costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    newest = F.max(F.struct(*by, *rest)).alias("_newest")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(*(F.col(c) if c in keys else F.col(f"_newest.{c}").alias(c) for c in df.columns))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_date: Column,
    right_date: str,
    *,
    how: str = "left",
) -> DataFrame:
    """Attach the latest right row dated on or before `left_date`.

    `on` pairs left and right equality columns; `right_date` is a DATE column. Adds the
    right columns that are not equality columns. Left rows without such a row get NULLs
    (how="left") or are dropped (how="inner"). A right row with a NULL key or date is in
    force nowhere; of rows with equal key and date the greatest by its other columns, in
    their order, counts.

    Each distinct (key, date) of the left side is resolved once and joined back by
    equality, whatever the sizes: questions and answers of a day are reduced before they
    are sent, so a window holds at most one row per key and calendar day.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"asof_join does not support {how!r}")
    keys = [r for _, r in on]
    slots = [f"_k{i}" for i in range(len(on))]
    payload = [c for c in right.columns if c not in keys]
    dated = left.withColumn("_on_date", left_date.cast("date"))
    asked = dated.select(
        *(F.col(n).alias(s) for (n, _), s in zip(on, slots)), "_on_date", F.lit(True).alias("_is_asked")
    )
    offered = right.select(
        *(F.col(k).alias(s) for k, s in zip(keys, slots)),
        F.col(right_date).cast("date").alias("_on_date"),
        F.struct(*payload).alias("_answer"),
    )
    both = asked.unionByName(offered, allowMissingColumns=True).dropna(subset=[*slots, "_on_date"])
    days = both.groupBy(*slots, "_on_date").agg(
        F.max("_answer").alias("_answer"), F.coalesce(F.max("_is_asked"), F.lit(False)).alias("_is_asked")
    )
    until_now = Window.partitionBy(*slots).orderBy("_on_date").rowsBetween(Window.unboundedPreceding, 0)
    answered = (
        days.withColumn("_found", F.last("_answer", ignorenulls=True).over(until_now))
        .filter(F.col("_is_asked") & F.col("_found").isNotNull())
        .select(*slots, F.col("_on_date").alias("_asked"), "_found")
    )
    match = F.col("_on_date") == F.col("_asked")
    for (name, _), slot in zip(on, slots):
        match = match & (F.col(name) == F.col(slot))
    joined = dated.join(answered, match, how)
    return joined.select(*left.columns, *(F.col(f"_found.{c}").alias(c) for c in payload))


def value_in_usd(events: DataFrame, rates: DataFrame) -> DataFrame:
    """Value provider events: reported USD, else local principal at the rate in force.

    The rate is 1 for USD. Values keep all 18 fractional digits; rounding happens when
    an event is recognised.
    """
    feed = rates.select("currency", "rate_date", "usd_rate")
    dated = asof_join(events, feed, [("currency", "currency")], F.col("event_timestamp_utc"), "rate_date")
    selected = F.when(F.col("currency") == "USD", F.lit(1).cast(RATE)).otherwise(F.col("usd_rate"))
    valued = (
        dated.withColumn("fx_rate_selected", selected)
        .withColumnRenamed("rate_date", "fx_date_selected")
        .withColumn(
            "amount_usd_normalized",
            F.coalesce(F.col("amount_usd_reported"), convert("amount_local_signed", "fx_rate_selected")),
        )
    )
    return conform(valued, VALUED_EVENT)


def contract_in_force(events: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Attach the tariff in force for (psp, account); events without one are dropped."""
    return asof_join(
        events,
        tariffs,
        [("psp", "psp"), ("provider_account", "account")],
        F.col("event_timestamp_utc"),
        "valid_from",
        how="inner",
    )
