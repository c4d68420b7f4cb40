"""Source rows to the common event and fee contracts, driven by declarative specs.

A spec is data: SQL expressions over the staged columns and lookup tables from source
values to common values. One spec gives one projection, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crosstally.functions.decimals import USD
from crosstally.operators.contracts import ENGINE_EVENT, MATCH, PROVIDER_EVENT, PROVIDER_FEE, conform

NEGATIVE_OPERATIONS = ("REFUND", "CHARGEBACK")

# SQL text, or a function that builds a column once a session exists.
Expression = str | Callable[[], Column]


def column(expression: Expression) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression()


def mapped(value: str, table: Mapping[str, str], default: str | None = None) -> Column:
    """Lookup of a column by equality; unknown and NULL values give the default."""
    otherwise = "NULL" if default is None else _literal(default)
    if not table:
        return F.expr(f"CAST({otherwise} AS STRING)")
    cases = " ".join(f"WHEN {_literal(source)} THEN {_literal(target)}" for source, target in table.items())
    return F.expr(f"CASE {value} {cases} ELSE {otherwise} END")


def financial_flag(kind: str, status: str, table: Mapping[tuple[str, str], bool]) -> Column:
    """True or false per supported (type, status) pair, NULL for every other pair."""
    if not table:
        return F.expr("CAST(NULL AS BOOLEAN)")
    cases = " ".join(
        f"WHEN {kind} = {_literal(k)} AND {status} = {_literal(s)} THEN {str(financial).lower()}"
        for (k, s), financial in table.items()
    )
    return F.expr(f"CASE {cases} END")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def signed(amount: Column, operation: Column, negative: Sequence[str] = NEGATIVE_OPERATIONS) -> Column:
    """Negate amounts of money-back operations; for sources that report unsigned amounts."""
    return F.when(operation.isin(*negative), -amount).otherwise(amount) if negative else amount


def from_registers(credit: Column, debit: Column) -> Column:
    """One signed amount from a credit and a debit column."""
    return F.coalesce(credit, -debit)


def attribute_id(event_time: Column, kind: Column, *attributes: Column) -> Column:
    """Event identity for a source without IDs: second-precision time, type and attributes."""
    stamp = F.date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss")
    slug = F.lower(F.replace(kind, F.lit(" "), F.lit("_")))
    return F.concat_ws("|", stamp, slug, *attributes)


def lifecycle_id(reference: Column, operation: Column) -> Column:
    """Event identity where one reference covers several operations; NULL if either is."""
    return F.concat(reference, F.lit(":"), F.lower(operation))


@dataclass(frozen=True)
class EventSpec:
    """How one provider's staged rows become provider events.

    `columns` maps contract columns to expressions over staged columns. `kind` and
    `status` name the staged columns behind the lookups; without `status`, the kind also
    decides the status. `event_id` and `amount_usd_reported` may use `_operation`, the
    mapped operation, and `_amount`, the signed local amount. With psp=None, `columns`
    holds an expression for psp.
    """

    psp: str | None
    kind: str
    operations: Mapping[str, str]
    columns: Mapping[str, Expression]
    event_id: Expression
    status: str | None = None
    statuses: Mapping[str, str] = field(default_factory=dict)
    status_default: str | None = None
    operation_default: str | None = None
    financial: Mapping[tuple[str, str], bool] = field(default_factory=dict)
    keep_only: Sequence[str] = ()
    negative: Sequence[str] = ()
    amount: Expression = "amount"
    amount_usd_reported: Expression = "CAST(NULL AS DECIMAL(20, 8))"


def by_kind(table: Mapping[str, bool]) -> dict[tuple[str, str], bool]:
    """Financial flags of a source whose kind is also its status."""
    return {(kind, kind): financial for kind, financial in table.items()}


def provider_events(staged: DataFrame, spec: EventSpec) -> DataFrame:
    """Apply one spec: final states only, mapped, signed, in contract order."""
    status = spec.status or spec.kind
    rows = staged.filter(F.col(spec.kind).isin(*spec.keep_only)) if spec.keep_only else staged
    operation = mapped(spec.kind, spec.operations, spec.operation_default)
    base = rows.select(
        "*",
        operation.alias("_operation"),
        mapped(status, spec.statuses, spec.status_default).alias("_status"),
        financial_flag(spec.kind, status, spec.financial).alias("_financial"),
        signed(column(spec.amount), operation, spec.negative).alias("_amount"),
    )
    events = base.select(
        *([F.lit(spec.psp).alias("psp")] if spec.psp else []),
        column(spec.event_id).alias("provider_event_id"),
        F.col("_operation").alias("operation_type"),
        F.col("_status").alias("status"),
        F.col(status).alias("source_status"),
        F.col("_financial").alias("is_financial_event"),
        F.col("_amount").alias("amount_local_signed"),
        column(spec.amount_usd_reported).alias("amount_usd_reported"),
        *(column(e).alias(name) for name, e in spec.columns.items()),
    )
    return conform(events, PROVIDER_EVENT)


def engine_events(ledger: DataFrame) -> DataFrame:
    """The internal ledger with signed principal and its two clocks.

    A settled row counts from its capture, a declined one from its creation; a pending
    row has no event time yet but stays in the scope of its creation month.
    """
    status, operation = F.col("status"), F.col("operation_type")
    settled = status == "settled"
    events = ledger.select(
        F.col("txn_id").alias("engine_txn_id"),
        *("psp psp_reference order_id operation_type status country sku currency".split()),
        "fx_date_applied",
        "fx_rate_applied",
        signed(F.col("amount_local"), operation).alias("amount_local_signed"),
        signed(F.col("amount_usd"), operation).cast(USD).alias("amount_usd_signed"),
        F.when(settled, F.col("captured_at_utc"))
        .when(status == "declined", F.col("created_at_utc"))
        .alias("event_timestamp_utc"),
        F.when(settled, F.col("captured_at_utc")).otherwise(F.col("created_at_utc")).alias("scope_timestamp_utc"),
        F.when(settled & operation.isin("SALE", *NEGATIVE_OPERATIONS), F.lit(True))
        .when(status.isin("pending", "declined"), F.lit(False))
        .alias("is_financial_event"),
    )
    return conform(events, ENGINE_EVENT)


@dataclass(frozen=True)
class FeeSpec:
    """How one provider's staged rows become fee rows.

    `components` maps a fee type to the SQL expression of its amount. With several
    components each staged row gives one fee row per component, NULL amounts included.
    """

    psp: str
    event_id: str
    currency: str
    components: Mapping[str, str]
    account: str = "CAST(NULL AS STRING)"
    where: str | None = None


def provider_fees(staged: DataFrame, spec: FeeSpec) -> DataFrame:
    """One fee row per staged row and component, read in one scan."""
    rows = staged.filter(spec.where) if spec.where else staged
    wide = rows.select(
        F.lit(spec.psp).alias("psp"),
        F.expr(spec.event_id).alias("provider_event_id"),
        F.expr(spec.account).alias("provider_account"),
        F.expr(spec.currency).alias("currency"),
        "source_file",
        *(F.expr(e).alias(kind) for kind, e in spec.components.items()),
    )
    ids = ["psp", "provider_event_id", "provider_account", "currency", "source_file"]
    return conform(wide.unpivot(ids, list(spec.components), "fee_type", "fee_amount"), PROVIDER_FEE)


def union_events(*parts: DataFrame) -> DataFrame:
    return _union(parts, PROVIDER_EVENT)


def union_fees(*parts: DataFrame) -> DataFrame:
    return _union(parts, PROVIDER_FEE)


def union_matches(*parts: DataFrame) -> DataFrame:
    return _union(parts, MATCH)


def _union(parts: Sequence[DataFrame], contract) -> DataFrame:
    return reduce(DataFrame.unionByName, (conform(p, contract) for p in parts))
