"""The monthly settlement run: snapshots in, gated reports out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crosstally.functions.decimals import tolerant
from crosstally.functions.times import iso_z
from crosstally.operators import adapters, fees as fee_ops, quality as q, reconcile as rec
from crosstally.operators.asof import latest_revision, value_in_usd
from crosstally.operators.contracts import FX_RATE, conform
from crosstally.operators.matching import link, match_all, matches_of, repeated_keys, unclear_of
from crosstally.plans import feeds
from crosstally.session import concurrently, pin_utc
from crosstally.sources.sinks import Report, materialise, materialise_counted, publish
from crosstally.sources.snapshots import raw, require_inputs, titled_line_problems

PROVIDERS = ("paypal_us", "paypal_eu", "dlocal", "adyen", "google_play")

Frames = dict[str, DataFrame]
Keep = Callable[[str, Frames], Frames]
Counts = Mapping[str, Column]


@dataclass(frozen=True)
class Settlement:
    """Every relation of a run. All frames are lazy or read from written layer tables."""

    raw: Frames
    staged: Frames
    source_events: Frames
    source_fees: Frames
    rates: DataFrame
    engine: DataFrame
    events: DataFrame
    matches: DataFrame
    fees: DataFrame
    detail: DataFrame
    summary: DataFrame
    fee_detail: DataFrame
    fee_summary: DataFrame
    months: Sequence[date]
    #: Violations counted while a layer was written, by layer table and check.
    observed: Mapping[str, Mapping[str, int]] = field(default_factory=dict)

    def reports(self) -> dict[str, Report]:
        return {
            "reconciliation_summary": payment_summary_report(self.summary),
            "reconciliation_details": payment_exceptions_report(self.detail),
            "fee_reconciliation_summary": fee_summary_report(self.fee_summary),
            "fee_reconciliation_details": fee_exceptions_report(self.fee_detail),
        }


def written_layers(root: str | None = None, counts: Callable[[], Mapping[str, Counts]] | None = None) -> Keep:
    """Keep layers as tables of this run below `root`, by default the shared folder.

    Tables of one call do not depend on each other and are written side by side. `counts`
    gives the violations to count in tables (`layer.name`) as they are written; the result's
    `observed` holds them.
    """
    run = uuid.uuid4().hex
    observed: dict[str, dict[str, int]] = {}

    def write(layer: str, name: str, df: DataFrame, wanted: Counts | None) -> DataFrame:
        if not wanted:
            return materialise(df, f"run_{run}/{layer}", name, root)
        table, found = materialise_counted(df, f"run_{run}/{layer}", name, wanted, root)
        if found is not None:
            observed[f"{layer}.{name}"] = found
        return table

    def keep(layer: str, frames: Frames) -> Frames:
        wanted = counts() if counts else {}
        writes = [partial(write, layer, name, df, wanted.get(f"{layer}.{name}")) for name, df in frames.items()]
        return dict(zip(frames, concurrently(writes)))

    keep.observed = observed
    return keep


def lazy_layers(layer: str, frames: Frames) -> Frames:
    """Keep nothing; for small data and plan inspection."""
    return frames


def settle(
    spark: SparkSession,
    snapshots: Frames,
    months: Sequence[date],
    keep: Keep | None = None,
    rounding: str = "exact",
) -> Settlement:
    """Relations of the run from raw snapshots (see `feeds.read_raw`).

    Staged feeds, events, matches and details have several readers each; `keep` decides
    whether they are written once or recomputed.
    """
    pin_utc(spark)
    keep = keep or written_layers(counts=declared_counts)
    staged = keep("staging", {name: feeds.STAGES[name](df) for name, df in snapshots.items()})

    by_source = {n: adapters.provider_events(staged[n], feeds.EVENT_SPECS[n]) for n in PROVIDERS}
    unvalued = adapters.union_events(*by_source.values())
    rates = latest_revision(staged["fx_rates"], ["rate_date", "currency"], ["published_at"])
    fees_by_source = [_source_fees(n, staged, by_source) for n in PROVIDERS]
    base = keep(
        "intermediate",
        {
            "engine_events": adapters.engine_events(staged["engine"]),
            "fx_rates": conform(rates, FX_RATE),
            "provider_fees": adapters.union_fees(*fees_by_source),
        },
    )
    engine, rates, fees = base["engine_events"], base["fx_rates"], base["provider_fees"]
    matched = keep(
        "intermediate",
        {
            "provider_events": value_in_usd(unvalued, rates),
            "links": link(engine, unvalued, feeds.MATCH_RULES),
        },
    )
    events, links = matched["provider_events"], matched["links"]
    matches, unclear = matches_of(links), unclear_of(links)
    details = keep(
        "marts",
        {
            "reconciliation_detail": rec.reconcile(engine, events, matches, months, ambiguous=unclear),
            "fee_reconciliation_detail": fee_ops.reconcile_fees(
                events, fees, staged["fee_schedule"], months, rounding
            ),
        },
    )
    detail, fee_detail = details["reconciliation_detail"], details["fee_reconciliation_detail"]
    summaries = keep(
        "marts",
        {
            "reconciliation_summary": rec.summarise(detail),
            "fee_reconciliation_summary": fee_ops.summarise_fees(fee_detail),
        },
    )
    return Settlement(
        raw=snapshots,
        staged=staged,
        source_events=by_source,
        source_fees={n: fees.filter(F.col("psp") == n) for n in PROVIDERS},
        rates=rates,
        engine=engine,
        events=events,
        matches=matches,
        fees=fees,
        detail=detail,
        summary=summaries["reconciliation_summary"],
        fee_detail=fee_detail,
        fee_summary=summaries["fee_reconciliation_summary"],
        months=list(months),
        observed=getattr(keep, "observed", {}),
    )


def _source_fees(name: str, staged: Frames, events: Frames) -> DataFrame:
    rows = staged[name]
    if name == "google_play":
        charges = events[name].filter("operation_type = 'SALE'")
        rows = rows.filter(F.col("transaction_type") == feeds.GOOGLE_FEE_KIND)
        rows = fee_ops.link_unique(rows, charges, feeds.GOOGLE_FEE_LINK, "provider_event_id", "charge_event_id")
    return adapters.provider_fees(rows, feeds.FEE_SPECS[name])


def run(
    spark: SparkSession,
    inputs: feeds.Inputs,
    months: Sequence[date],
    output: str,
    keep: Keep | None = None,
    rounding: str = "exact",
) -> Settlement:
    """Require inputs, settle, check, and publish the four reports if all checks pass."""
    pin_utc(spark)
    require_inputs(spark, inputs.all_paths())
    result = settle(spark, feeds.read_raw(spark, inputs), months, keep, rounding)
    titles = titled_line_problems(spark, inputs.google_play, feeds.GOOGLE_COLUMNS, inputs.google_title)
    publish(result.reports(), [*checks(result), q.counted("google_play_title_lines", titles)], output)
    return result


# -- checks -------------------------------------------------------------------------

# Columns that must be filled and the values a column may take.
_PAYPAL_REQUIRED = (
    "transaction_id transaction_type status currency gross_amount fee_amount net_amount event_timestamp_utc"
).split()
REQUIRED_STAGED = {
    "engine": ["txn_id", "operation_type"],
    "paypal_us": _PAYPAL_REQUIRED,
    "paypal_eu": _PAYPAL_REQUIRED,
    "dlocal": (
        "transaction_id transaction_type status currency currency_exponent local_amount fx_rate usd_amount "
        "fee_usd event_timestamp_utc"
    ).split(),
    "adyen": "psp_reference merchant_account record_type gross_currency net_currency event_timestamp_utc".split(),
    "google_play": (
        "transaction_type product_id buyer_currency merchant_currency buyer_amount merchant_amount "
        "currency_conversion_rate event_timestamp_utc"
    ).split(),
    "fx_rates": "rate_date currency usd_rate published_at".split(),
    "fee_schedule": ["percent_fee", "fixed_fee"],
}
ACCEPTED_STAGED = {
    "engine": {"operation_type": ["SALE", "REFUND", "CHARGEBACK"]},
    "paypal_us": {"transaction_type": ["Website Payment", "Refund"]},
    "paypal_eu": {"transaction_type": ["Website Payment", "Refund", "Payment Reversal"]},
    "dlocal": {"transaction_type": ["PAYMENT", "REFUND"]},
    "adyen": {"record_type": ["Authorised", "Settled", "Refused", "Refunded", "Chargeback"]},
    "google_play": {"transaction_type": ["Charge", "Charge refund", "Google fee"]},
}
REQUIRED_DETAIL = (
    "engine_in_period provider_in_period engine_is_financial_event provider_is_financial_event signed_usd_impact"
).split()
REQUIRED_FEE_DETAIL = "reported_fee_local expected_fee_local signed_fee_variance_usd".split()


def checks(s: Settlement) -> list[DataFrame]:
    """All checks of the run as small frames (check, violations); one frame holds what belongs together."""
    declared = _declared_checks(s)
    groups = (_staging_checks, _source_checks, _matching_checks, _report_checks)
    return [*declared, *(q.all_checks(*group(s)) for group in groups)]


def declared_counts() -> dict[str, Counts]:
    """Violations of declared columns and rows, as aggregates by layer table."""
    balanced = {"paypal_us": ["Completed", "Refunded"], "paypal_eu": ["Completed", "Refunded", "Reversed"]}
    staged_rules = {
        name: {
            f"amount_balance:{name}": q.is_unbalanced(
                ["gross_amount", "fee_amount"], "net_amount", F.col("status").isin(*statuses)
            )
        }
        for name, statuses in balanced.items()
    }
    charge = F.col("transaction_type").isin("Charge", "Charge refund")
    staged_rules["google_play"] = {"events_usd:google_play": charge & (F.col("merchant_currency") != "USD")}
    tables = {
        f"staging.{n}": q.column_counts(f"staging.{n}", required, ACCEPTED_STAGED.get(n), staged_rules.get(n))
        for n, required in REQUIRED_STAGED.items()
    }
    sold_back = F.expr(
        "(operation_type = 'SALE' AND amount_local_signed < 0) OR (operation_type = 'REFUND' AND amount_local_signed > 0)"
    )
    event_rules = {
        "fx_coverage": q.has_valuation_gap(),
        "events_sign:paypal_us": (F.col("psp") == "paypal_us") & sold_back,
        "events_complete:google_play": (F.col("psp") == "google_play")
        & F.expr("provider_event_id IS NULL OR country IS NULL OR sku IS NULL"),
    }
    unlinked = {"google_play_fees_linked": F.expr("psp = 'google_play' AND provider_event_id IS NULL")}
    return {
        **tables,
        "intermediate.engine_events": q.column_counts("engine_events", ["is_financial_event"]),
        "intermediate.provider_events": q.column_counts(
            "provider_events", ["provider_event_id", "psp", "is_financial_event"], rules=event_rules
        ),
        "intermediate.provider_fees": q.column_counts("provider_fees", ["fee_amount"], rules=unlinked),
        "marts.reconciliation_detail": q.column_counts("reconciliation_detail", REQUIRED_DETAIL),
        "marts.fee_reconciliation_detail": q.column_counts("fee_reconciliation_detail", REQUIRED_FEE_DETAIL),
    }


def _declared_checks(s: Settlement) -> list[DataFrame]:
    """Counts taken while layers were written; tables without them are scanned."""
    frames = {f"staging.{n}": df for n, df in s.staged.items()} | {
        "intermediate.engine_events": s.engine,
        "intermediate.provider_events": s.events,
        "intermediate.provider_fees": s.fees,
        "marts.reconciliation_detail": s.detail,
        "marts.fee_reconciliation_detail": s.fee_detail,
    }
    scanned = [q.counts_of(frames[t], counts) for t, counts in declared_counts().items() if t not in s.observed]
    known = [pair for counts in s.observed.values() for pair in counts.items()]
    seen = [s.engine.sparkSession.createDataFrame(known, "check string, violations long")] if known else []
    matches = q.column_checks(s.matches, "provider_matches", ["engine_txn_id", "provider_event_id", "match_method"])
    return [*seen, *scanned, matches]


def _staging_checks(s: Settlement) -> list[DataFrame]:
    adyen_amounts = {c: tolerant(raw(c)) for c in feeds.ADYEN_AMOUNTS}
    typed_rates = s.raw["fx_rates"].select(
        F.col("rate_date").cast("date"), "currency", F.col("usd_rate").cast("decimal(18,10)"),
        F.col("published_at").cast("timestamp"),
    )
    return [
        *(
            q.counted(f"row_count:{n}", q.lost_rows(s.raw[n], s.staged[n]))
            for n in ("paypal_us", "paypal_eu", "dlocal", "adyen")
        ),
        q.counted("row_count:engine", q.lost_rows(s.raw["engine"], s.staged["engine"], copies_removed=False)),
        q.counted("row_count:fx_rates", q.lost_rows(typed_rates, s.staged["fx_rates"])),
        q.counted("row_count:google_play", q.lost_rows_per_group(s.raw["google_play"], s.staged["google_play"])),
        q.counted("unique:engine.txn_id", q.repeated_rows(s.staged["engine"], ["txn_id"])),
        q.counted(
            "key:fee_schedule",
            q.repeated_rows(s.staged["fee_schedule"], ["psp", "account", "valid_from"], parts_required=True),
        ),
        q.counted(
            "key:fx_rates", q.repeated_rows(s.staged["fx_rates"], ["rate_date", "currency", "published_at"])
        ),
        q.counted("amount_parsing:adyen", q.unparsed(s.raw["adyen"], adyen_amounts)),
    ]


@dataclass(frozen=True)
class Expectation:
    """What a source says about its events, stated apart from the adapter specs.

    `columns` names the staged columns: event_id, reference, order, account, country,
    currency, amount. `usd` is SQL over the staged columns and `_amount`, unsigned.
    """

    kind: str
    state: str
    columns: dict[str, str]
    operations: dict[str, str]
    states: dict[str, str]
    financial: dict[tuple[str, str], bool]
    usd: str = "NULL"
    rate: str = "NULL"
    negative: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    lifecycle: bool = False
    other: tuple[str, str] = ("OTHER", "unknown")


# Source types and states and what they mean.
_PAYPAL_COLUMNS = {
    "event_id": "transaction_id", "reference": "transaction_id", "order": "invoice_id", "currency": "currency",
    "amount": "gross_amount",
}
EXPECTED_EVENTS = {
    "paypal_us": Expectation(
        "transaction_type",
        "status",
        _PAYPAL_COLUMNS,
        {"Website Payment": "SALE", "Refund": "REFUND"},
        {"Completed": "settled", "Refunded": "settled", "Denied": "declined"},
        {
            ("Website Payment", "Completed"): True,
            ("Website Payment", "Denied"): False,
            ("Refund", "Refunded"): True,
        },
        usd="IF(currency = 'USD', _amount, NULL)",
    ),
    "paypal_eu": Expectation(
        "transaction_type",
        "status",
        _PAYPAL_COLUMNS,
        {"Website Payment": "SALE", "Refund": "REFUND", "Payment Reversal": "REVERSAL"},
        {"Completed": "settled", "Refunded": "settled", "Reversed": "settled", "Denied": "declined"},
        {
            ("Website Payment", "Completed"): True,
            ("Website Payment", "Denied"): False,
            ("Refund", "Refunded"): True,
            ("Payment Reversal", "Reversed"): True,
        },
    ),
    "dlocal": Expectation(
        "transaction_type",
        "status",
        {
            "event_id": "transaction_id", "reference": "transaction_id", "order": "invoice_id", "country": "country",
            "currency": "currency", "amount": "local_amount",
        },
        {"PAYMENT": "SALE", "REFUND": "REFUND"},
        {"PAID": "settled", "REFUNDED": "settled", "REJECTED": "declined", "IN_MEDIATION": "disputed"},
        {
            ("PAYMENT", "PAID"): True,
            ("PAYMENT", "REJECTED"): False,
            ("PAYMENT", "IN_MEDIATION"): False,
            ("REFUND", "REFUNDED"): True,
        },
        usd="usd_amount",
        rate="try_divide(1D, CAST(fx_rate AS DOUBLE))",
        negative=("REFUND",),
    ),
    "adyen": Expectation(
        "record_type",
        "record_type",
        {
            "event_id": "psp_reference", "reference": "psp_reference", "order": "merchant_reference",
            "account": "merchant_account", "currency": "gross_currency",
            "amount": "ifnull(gross_credit, -gross_debit)",
        },
        {"Settled": "SALE", "Refused": "SALE", "Refunded": "REFUND", "Chargeback": "CHARGEBACK"},
        {"Settled": "settled", "Refused": "declined", "Refunded": "settled", "Chargeback": "settled"},
        {
            ("Settled", "Settled"): True,
            ("Refused", "Refused"): False,
            ("Refunded", "Refunded"): True,
            ("Chargeback", "Chargeback"): True,
        },
        usd="IF(gross_currency = 'USD', _amount, NULL)",
        ignored=("Authorised",),
        lifecycle=True,
    ),
}


def _expected_events(s: Settlement, name: str) -> DataFrame:
    """Staged rows with the meaning of their type and state joined in from the fixed tables."""
    e, rows = EXPECTED_EVENTS[name], s.staged[name]
    spark = rows.sparkSession
    operations = spark.createDataFrame(list(e.operations.items()), "_kind string, _operation string")
    states = spark.createDataFrame(list(e.states.items()), "_state string, _status string")
    flags = spark.createDataFrame([(*k, v) for k, v in e.financial.items()], "_kind string, _state string, _flag boolean")
    staged = rows.filter(~F.col(e.kind).isin(*e.ignored)) if e.ignored else rows
    staged = staged.withColumns({"_kind": F.col(e.kind), "_state": F.col(e.state), "_amount": F.expr(e.columns["amount"])})
    known = staged.join(operations, "_kind", "left").join(states, "_state", "left").join(flags, ["_kind", "_state"], "left")
    operation, status = F.coalesce("_operation", F.lit(e.other[0])), F.coalesce("_status", F.lit(e.other[1]))
    sign = F.when(operation.isin(*e.negative), F.lit(-1)).otherwise(F.lit(1)) if e.negative else F.lit(1)

    def text(role: str) -> Column:
        return F.expr(e.columns[role]) if role in e.columns else F.lit(None).cast("string")

    event_id = F.concat_ws(":", text("event_id"), F.lower(operation)) if e.lifecycle else text("event_id")
    return known.select(
        event_id.alias("provider_event_id"),
        text("reference").alias("psp_reference"),
        text("order").alias("order_id"),
        text("account").alias("provider_account"),
        text("country").alias("country"),
        text("currency").alias("currency"),
        (F.col("_amount") * sign).cast("decimal(20,8)").alias("amount_local_signed"),
        (F.expr(e.usd).cast("decimal(20,8)") * sign).cast("decimal(20,8)").alias("amount_usd_reported"),
        F.expr(e.rate).cast("decimal(18,10)").alias("fx_rate_reported"),
        operation.alias("operation_type"),
        status.alias("status"),
        F.col("_flag").alias("is_financial_event"),
    )


@dataclass(frozen=True)
class FeeExpectation:
    """Fee types of a source and the staged columns that hold them."""

    parts: dict[str, str]
    currency: str
    event_id: str = "transaction_id"
    account: str = "CAST(NULL AS STRING)"
    only: str = "true"


# Which columns are fees. Deductions are negative in the source.
EXPECTED_FEES = {
    "paypal_us": FeeExpectation({"total": "-fee_amount"}, "currency"),
    "paypal_eu": FeeExpectation({"total": "-fee_amount"}, "currency"),
    "dlocal": FeeExpectation({"total": "fee_usd"}, "'USD'"),
    "adyen": FeeExpectation(
        {"markup": "markup", "commission": "commission"},
        "net_currency",
        event_id="psp_reference || ':sale'",
        account="merchant_account",
        only="record_type = 'Settled'",
    ),
}


def _expected_fees(s: Settlement, name: str) -> DataFrame:
    e = EXPECTED_FEES[name]
    rows = s.staged[name].filter(e.only)
    parts = F.array(
        *(F.struct(F.lit(t).alias("fee_type"), F.expr(x).cast("decimal(20,8)").alias("fee_amount")) for t, x in e.parts.items())
    )
    return rows.select(
        F.lit(name).alias("psp"),
        F.expr(e.event_id).alias("provider_event_id"),
        F.expr(e.account).alias("provider_account"),
        F.expr(e.currency).alias("currency"),
        F.inline(parts),
    )


def _source_checks(s: Settlement) -> list[DataFrame]:
    """Events and fees against their sources."""
    with_ids = ("paypal_us", "paypal_eu", "dlocal", "adyen")
    results = []
    for name in with_ids:
        expected = _expected_events(s, name)
        values = [c for c in expected.columns if c != "provider_event_id"]
        differing = q.differing_keys(expected, s.source_events[name], ["provider_event_id"], values)
        results.append(q.counted(f"events_source:{name}", differing))
        wrong = q.fee_differences(_expected_fees(s, name), s.source_fees[name], s.source_events[name])
        results.append(q.counted(f"fees_source:{name}", wrong))
    events = s.source_events["google_play"]
    staged = s.staged["google_play"]
    charges = staged.filter("transaction_type IN ('Charge', 'Charge refund')")
    fee_rows = staged.filter(F.col("transaction_type") == feeds.GOOGLE_FEE_KIND)
    fees = s.source_fees["google_play"]
    return [
        *results,
        q.counted("events_key:paypal_us", q.repeated_rows(s.source_events["paypal_us"], ["psp", "provider_event_id"])),
        q.counted(
            "events_source:google_play",
            q.control_totals(
                charges,
                events,
                {
                    "records": ("count(1)", "count(1)"),
                    "amount_local": ("sum(buyer_amount)", "sum(amount_local_signed)"),
                    "amount_usd": ("sum(merchant_amount)", "sum(amount_usd_reported)"),
                },
            ),
        ),
        q.counted(
            "fees_source:google_play",
            q.control_totals(
                fee_rows,
                fees,
                {"records": ("count(1)", "count(1)"), "fees": ("-sum(merchant_amount)", "sum(fee_amount)")},
            ),
        ),
        q.counted("fees_event:google_play", q.homeless_fees(fees, events)),
        q.counted(
            "unresolved:adyen",
            q.unresolved(s.staged["adyen"], "psp_reference", "record_type", ["Authorised"], ["Settled", "Refused"]),
            "open_rows",
        ),
    ]


def _matching_checks(s: Settlement) -> list[DataFrame]:
    adyen = F.col("psp") == "adyen"
    rules = [r for r in feeds.MATCH_RULES if r.psps == ("adyen",)]
    again = match_all(s.engine, s.events, rules)
    return [
        q.counted("match_keys", q.match_key_problems(s.matches, s.events)),
        q.counted("match_repeated_keys", repeated_keys(s.engine, s.events, feeds.MATCH_RULES)),
        q.counted("matches_source:adyen", q.multiset_differences(again, s.matches.filter(adyen)), "excess"),
    ]


def _report_checks(s: Settlement) -> list[DataFrame]:
    tariffs = s.staged["fee_schedule"]
    return [
        q.counted("summary_totals", q.summary_differences(s.detail, s.summary), "excess"),
        q.counted("source_totals", q.source_total_gaps(s.engine, s.events, s.detail, s.months)),
        q.counted("fee_scope", q.fee_scope_differences(s.events, tariffs, s.fee_detail, s.months)),
        q.counted("fee_summary_totals", q.fee_summary_differences(s.fee_detail, s.fee_summary)),
    ]


# -- reports ------------------------------------------------------------------------


def _money(*names: str, **renamed: str) -> list[Column]:
    cast = [F.col(n).cast("decimal(20,2)").alias(n) for n in names]
    return cast + [F.col(n).cast("decimal(20,2)").alias(alias) for alias, n in renamed.items()]


def _plain(*names: str) -> list[Column]:
    return [F.col(n) for n in names]


def payment_summary_report(summary: DataFrame) -> Report:
    return Report(
        summary,
        [
            *_plain("report_month", "psp", "cause", "engine_record_count", "provider_record_count"),
            *_plain("record_count_difference"),
            *_money("engine_amount_usd", "provider_amount_usd", "signed_usd_impact", "absolute_usd_impact"),
            F.col("absolute_impact_share_pct"),
        ],
        ["report_month", "psp", "cause"],
    )


def payment_exceptions_report(detail: DataFrame) -> Report:
    return Report(
        rec.exceptions(detail),
        [
            *_plain("report_month", "psp", "engine_txn_id", "provider_event_id", "match_status", "cause"),
            *_plain("engine_operation_type", "provider_operation_type", "engine_status", "provider_status"),
            iso_z("engine_event_timestamp_utc").alias("engine_event_timestamp_utc"),
            iso_z("provider_event_timestamp_utc").alias("provider_event_timestamp_utc"),
            *_plain("engine_currency", "provider_currency"),
            F.col("engine_amount_local_signed").alias("engine_amount_local"),
            F.col("provider_amount_local_signed").alias("provider_amount_local"),
            *_money(
                engine_amount_usd="engine_amount_usd_signed",
                provider_amount_usd="provider_amount_usd_normalized",
                signed_usd_impact="signed_usd_impact",
            ),
        ],
        ["report_month", "psp", "cause", "engine_txn_id", "provider_event_id"],
    )


def fee_summary_report(summary: DataFrame) -> Report:
    return Report(
        summary,
        [
            *_plain("report_month", "psp", "provider_account", "fee_currency", "cause", "event_count"),
            *_money("reported_fee_local", "expected_fee_local", "signed_fee_variance_local", "reported_fee_usd"),
            *_money("expected_fee_usd", "signed_fee_variance_usd", "absolute_fee_variance_usd"),
        ],
        ["report_month", "psp", "provider_account", "fee_currency", "cause"],
    )


def fee_exceptions_report(detail: DataFrame) -> Report:
    return Report(
        rec.exceptions(detail),
        [
            *_plain("report_month", "psp", "provider_event_id", "provider_account"),
            iso_z("event_timestamp_utc").alias("event_timestamp_utc"),
            *_plain("fee_currency", "contract_valid_from"),
            F.col("percent_fee").cast("decimal(12,4)").alias("percent_fee"),
            *_money("fixed_fee"),
            F.col("fixed_fee_currency"),
            *_money("reported_fee_local", "expected_fee_local", "signed_fee_variance_local"),
            *_money("signed_fee_variance_usd"),
        ],
        ["report_month", "psp", "provider_account", "provider_event_id"],
    )
