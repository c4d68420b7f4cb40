"""Two-sided reconciliation: keep everything, attribute to months, one cause per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from crosstally.functions.decimals import USD, cents, minus
from crosstally.operators.matching import ENGINE_ID, PROVIDER_ID

_ENGINE_COLUMNS = {
    "operation_type": "engine_operation_type",
    "status": "engine_status",
    "currency": "engine_currency",
    "fx_date_applied": "engine_fx_date",
    "fx_rate_applied": "engine_fx_rate",
    "amount_local_signed": "engine_amount_local_signed",
    "amount_usd_signed": "engine_amount_usd_signed",
    "event_timestamp_utc": "engine_event_timestamp_utc",
    "scope_timestamp_utc": "engine_scope_timestamp_utc",
    "is_financial_event": "engine_is_financial_event",
}
_PROVIDER_COLUMNS = {
    "operation_type": "provider_operation_type",
    "status": "provider_status",
    "currency": "provider_currency",
    "fx_date_selected": "provider_fx_date",
    "fx_rate_reported": "provider_fx_rate_reported",
    "fx_rate_selected": "provider_fx_rate",
    "amount_local_signed": "provider_amount_local_signed",
    "amount_usd_reported": "provider_amount_usd_reported",
    "amount_usd_normalized": "provider_amount_usd_normalized",
    "event_timestamp_utc": "provider_event_timestamp_utc",
    "is_financial_event": "provider_is_financial_event",
}


def pair_set(
    engine: DataFrame, provider: DataFrame, matches: DataFrame, ambiguous: DataFrame | None = None
) -> DataFrame:
    """Matched pairs, engine rows without a match and provider rows without one.

    `matches` refers to rows of these two frames. One left join per side finds what is
    linked: adaptive execution can split a skewed key of a left join, which it cannot
    for a full outer join. A row with a NULL ID equals nothing and stays unmatched. IDs come
    first among the keys, as sorts compare the first eight bytes at once.
    `ambiguous` (psp, side, id) marks rows whose key repeats on both sides: they are
    unmatched, but not known to be missing.
    """
    e = engine.select("psp", ENGINE_ID, *(F.col(c).alias(a) for c, a in _ENGINE_COLUMNS.items()))
    p = provider.select("psp", PROVIDER_ID, *(F.col(c).alias(a) for c, a in _PROVIDER_COLUMNS.items()))
    links = matches.select("psp", ENGINE_ID, PROVIDER_ID, "match_method")
    linked = _psp_first(e.join(links, [ENGINE_ID, "psp"], "left"))
    matched = _psp_first(linked.filter(F.col(PROVIDER_ID).isNotNull()).join(p, [PROVIDER_ID, "psp"]))
    engine_only = linked.filter(F.col(PROVIDER_ID).isNull()).drop(PROVIDER_ID)
    provider_only = p.join(links.select("psp", PROVIDER_ID), [PROVIDER_ID, "psp"], "left_anti")
    unclear = F.lit(False)
    if ambiguous is not None:
        engine_only = _marked(engine_only, ambiguous, "E", ENGINE_ID)
        provider_only = _marked(provider_only, ambiguous, "P", PROVIDER_ID)
    else:
        engine_only, provider_only = (df.withColumn("ambiguous_key", unclear) for df in (engine_only, provider_only))
    parts = {
        "matched": matched.withColumn("ambiguous_key", unclear),
        "engine_only": engine_only,
        "provider_only": provider_only,
    }
    labelled = (df.withColumn("match_status", F.lit(status)) for status, df in parts.items())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def _psp_first(rows: DataFrame) -> DataFrame:
    return rows.select("psp", *(c for c in rows.columns if c != "psp"))


def _marked(rows: DataFrame, ambiguous: DataFrame, side: str, row_id: str) -> DataFrame:
    of_side = ambiguous.filter(F.col("side") == side).select(
        "psp", F.col("id").alias(row_id), F.lit(True).alias("ambiguous_key")
    )
    return rows.join(of_side, ["psp", row_id], "left").withColumn(
        "ambiguous_key", F.coalesce("ambiguous_key", F.lit(False))
    )


def in_month(ts: Column | str, month: Column) -> Column:
    """Whether a timestamp lies in the UTC month that starts on `month`; NULL if unknown."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (ts >= month.cast("timestamp")) & (ts < F.add_months(month, 1).cast("timestamp"))


def _month_after(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def attribute_period(pairs: DataFrame, months: Sequence[date]) -> DataFrame:
    """Say for each report month whether either side falls into it, and keep those rows.

    An absent side is outside every month and carries no principal; a present side
    without a time is unknown (NULL) and stays in every month asked for, to surface as
    unexplained. Late settlements stay linked because matching came first.
    """
    for month in months:
        if month.day != 1:
            raise ValueError(f"report month {month} is not the first day of a month")
    wanted = sorted(dict.fromkeys(months))
    clocks = ("engine_scope_timestamp_utc", "provider_event_timestamp_utc")
    first, after = (F.lit(str(m)).cast("timestamp") for m in (wanted[0], _month_after(wanted[-1])))
    absent = {clocks[0]: "provider_only", clocks[1]: "engine_only"}
    unknown = reduce(
        Column.__or__, ((F.col("match_status") != side) & F.col(c).isNull() for c, side in absent.items())
    )
    # Plain bounds, so that they reach the scans of both sides.
    near = reduce(Column.__or__, ((F.col(c) >= first) & (F.col(c) < after) for c in clocks), unknown)
    if len(wanted) == 1:
        scoped = pairs.filter(near).withColumn("report_month", F.lit(wanted[0]).cast("date"))
    else:
        # A pair has at most two months of its own; one without a time stays in all.
        all_months = F.array(*(F.lit(m).cast("date") for m in wanted))
        own = F.array_intersect(F.array(*(F.trunc(c, "MM") for c in clocks)), all_months)
        month = F.explode(F.when(unknown, all_months).otherwise(own))
        scoped = pairs.filter(near).withColumn("report_month", month)
    month = F.col("report_month")
    has_engine, has_provider = F.col("match_status") != "provider_only", F.col("match_status") != "engine_only"

    def of_side(present: Column, value: Column) -> Column:
        return F.when(present, value).otherwise(F.lit(False))

    return scoped.withColumns(
        {
            "engine_in_period": of_side(has_engine, in_month("engine_scope_timestamp_utc", month)),
            "provider_in_period": of_side(has_provider, in_month("provider_event_timestamp_utc", month)),
            "engine_is_financial_event": of_side(has_engine, F.col("engine_is_financial_event")),
            "provider_is_financial_event": of_side(has_provider, F.col("provider_is_financial_event")),
        }
    )


def measure(scoped: DataFrame) -> DataFrame:
    """Recognised USD per side, differences between the sides, signed and absolute impact."""

    def recognised(side: str, amount: Column) -> Column:
        silent = ~F.col(f"{side}_in_period") | ~F.col(f"{side}_is_financial_event")
        return F.when(silent, F.lit(0).cast(USD)).otherwise(amount.cast(USD))

    paired = F.col("match_status") == "matched"

    def differs(attribute: str) -> Column:
        return F.when(paired, ~F.col(f"engine_{attribute}").eqNullSafe(F.col(f"provider_{attribute}")))

    local_gap = F.col("provider_amount_local_signed") - F.col("engine_amount_local_signed")
    same_currency = F.col("engine_currency") == F.col("provider_currency")
    measured = scoped.withColumns(
        {
            "engine_recognized_usd": recognised("engine", F.col("engine_amount_usd_signed")),
            "provider_recognized_usd": recognised("provider", cents("provider_amount_usd_normalized")),
            "operation_type_differs": differs("operation_type"),
            "status_differs": differs("status"),
            "currency_differs": differs("currency"),
            "amount_local_difference": F.when(same_currency, local_gap),
            "amount_usd_difference": minus("provider_amount_usd_normalized", "engine_amount_usd_signed"),
        }
    )
    impact = minus("provider_recognized_usd", "engine_recognized_usd")
    return measured.withColumns({"signed_usd_impact": impact, "absolute_usd_impact": F.abs(impact)})


@dataclass(frozen=True)
class CauseRule:
    """A cause and the SQL condition under which it applies."""

    cause: str
    condition: str


_UNKNOWN = (
    "engine_recognized_usd",
    "provider_recognized_usd",
    "engine_in_period",
    "provider_in_period",
    "engine_is_financial_event",
    "provider_is_financial_event",
)
_PROVIDER_RATE = "coalesce(provider_fx_rate_reported, provider_fx_rate)"
_SAME_LOCAL_OFF = "signed_usd_impact <> 0 AND amount_local_difference = 0"


def cause_rules(tolerance: str = "0.01") -> list[CauseRule]:
    """The causes in order of precedence; the first rule that holds names the cause.

    Unknown facts and keys that repeat on both sides come first, then a missing side, then identity, status and timing
    differences, then valuation. Callers may insert rules of their own.
    """
    missing = {
        "REFUND": "refund_missing_in_engine",
        "REVERSAL": "reversal_missing_in_engine",
        "CHARGEBACK": "chargeback_missing_in_engine",
    }
    return [
        CauseRule("unexplained", " OR ".join(["ambiguous_key", *(f"{c} IS NULL" for c in _UNKNOWN)])),
        CauseRule("engine_only", "match_status = 'engine_only'"),
        *(
            CauseRule(cause, f"match_status = 'provider_only' AND provider_operation_type = '{op}'")
            for op, cause in missing.items()
        ),
        CauseRule("provider_only", "match_status = 'provider_only'"),
        CauseRule("unexplained", "operation_type_differs OR currency_differs"),
        CauseRule("status_lifecycle_difference", "status_differs"),
        CauseRule(
            "cutoff_timing",
            "engine_is_financial_event AND provider_is_financial_event AND engine_in_period <> provider_in_period",
        ),
        CauseRule("fx_difference", f"{_SAME_LOCAL_OFF} AND NOT (engine_fx_rate <=> {_PROVIDER_RATE})"),
        CauseRule(
            "rounding_difference",
            f"{_SAME_LOCAL_OFF} AND absolute_usd_impact <= {tolerance} AND engine_fx_rate <=> {_PROVIDER_RATE}",
        ),
        CauseRule("amount_difference", "signed_usd_impact <> 0"),
    ]


def classify(measured: DataFrame, rules: Sequence[CauseRule] | None = None, otherwise: str = "matched") -> DataFrame:
    """Exactly one cause per row; without a mark no key counts as ambiguous."""
    if "ambiguous_key" not in measured.columns:
        measured = measured.withColumn("ambiguous_key", F.lit(False))
    cases = " ".join(f"WHEN {r.condition} THEN '{r.cause}'" for r in (cause_rules() if rules is None else rules))
    return measured.withColumn("cause", F.expr(f"CASE {cases} ELSE '{otherwise}' END" if cases else f"'{otherwise}'"))


def reconcile(
    engine: DataFrame,
    provider: DataFrame,
    matches: DataFrame,
    months: Sequence[date],
    rules: Sequence[CauseRule] | None = None,
    ambiguous: DataFrame | None = None,
) -> DataFrame:
    """Reconciliation detail of the report months, one row per pair or unmatched event.

    Pass `ambiguous_rows` of the same rules, so that rows whose keys repeat on both sides
    are unexplained rather than reported as missing.
    """
    pairs = pair_set(engine, provider, matches, ambiguous)
    return classify(measure(attribute_period(pairs, months)), rules).drop("ambiguous_key")


def cause_totals(detail: DataFrame) -> DataFrame:
    """Counts and sums per month, provider and cause.

    Flags are summed as integers, so that a group of unknown flags stays NULL.
    """

    def flags(condition: str) -> Column:
        return F.sum(F.expr(f"CAST(({condition}) AS INT)"))

    return detail.groupBy("report_month", "psp", "cause").agg(
        F.count(F.lit(1)).alias("row_count"),
        flags("engine_in_period").alias("engine_record_count"),
        flags("provider_in_period").alias("provider_record_count"),
        flags("engine_in_period AND engine_is_financial_event").alias("engine_financial_count"),
        flags("provider_in_period AND provider_is_financial_event").alias("provider_financial_count"),
        F.sum("engine_recognized_usd").alias("engine_amount_usd"),
        F.sum("provider_recognized_usd").alias("provider_amount_usd"),
        F.sum("signed_usd_impact").alias("signed_usd_impact"),
        F.sum("absolute_usd_impact").alias("absolute_usd_impact"),
    )


def summarise(detail: DataFrame) -> DataFrame:
    """Cause totals with count differences and the share of the month's absolute impact."""
    totals = cause_totals(detail)
    # One row per provider and cause is left per month here.
    month_total = F.sum("absolute_usd_impact").over(Window.partitionBy("report_month"))
    share = F.lit(100.0) * F.col("absolute_usd_impact").cast("double") / F.nullif(month_total, F.lit(0)).cast("double")
    return (
        totals.withColumn("record_count_difference", F.expr("provider_record_count - engine_record_count"))
        .withColumn("financial_count_difference", F.expr("provider_financial_count - engine_financial_count"))
        .withColumn("absolute_impact_share_pct", share.cast("decimal(9,4)"))
    )


def exceptions(detail: DataFrame) -> DataFrame:
    """Rows that did not fully match."""
    return detail.filter(F.col("cause") != "matched")
