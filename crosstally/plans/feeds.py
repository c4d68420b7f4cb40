"""The engine ledger and five provider feeds: staging projections and specs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from crosstally.functions import times
from crosstally.functions.decimals import MONEY, RATE, decimal_comma, invert_rate, minor_to_major, tolerant
from crosstally.operators.adapters import EventSpec, FeeSpec, attribute_id, by_kind, from_registers, lifecycle_id
from crosstally.operators.contracts import TARIFF, conform
from crosstally.operators.copies import drop_exact_copies, drop_typed_copies
from crosstally.operators.matching import MatchRule
from crosstally.sources.snapshots import SOURCE_FILE, raw, read_snapshot, read_titled_snapshot

# Source headers.
ENGINE_COLUMNS = (
    "txn_id order_id operation_type status psp psp_reference sku country currency amount_local "
    "fx_rate_applied fx_date_applied amount_usd created_at_utc captured_at_utc"
).split()
PAYPAL_COLUMNS = [
    "Date",
    "Time",
    "Time Zone",
    "Name",
    "Transaction ID",
    "Reference Txn ID",
    "Type",
    "Status",
    "Currency",
    "Gross",
    "Fee",
    "Net",
    "Invoice ID",
]
DLOCAL_COLUMNS = (
    "transaction_id invoice_id transaction_type status created_at_utc country currency "
    "currency_exponent local_amount fx_rate usd_amount fee_usd"
).split()
ADYEN_COLUMNS = [
    "Company Account",
    "Merchant Account",
    "Psp Reference",
    "Merchant Reference",
    "Record Type",
    "Creation Date",
    "TimeZone",
    "Gross Currency",
    "Gross Debit",
    "Gross Credit",
    "Commission",
    "Markup",
    "Net Currency",
    "Net Debit",
    "Net Credit",
    "Batch Number",
]
GOOGLE_COLUMNS = [
    "Transaction Date",
    "Transaction Time",
    "Transaction Type",
    "Product ID",
    "Buyer Country",
    "Buyer Currency",
    "Amount (Buyer Currency)",
    "Currency Conversion Rate",
    "Merchant Currency",
    "Amount (Merchant Currency)",
]
GOOGLE_TITLE = r"^Earnings report for "
GOOGLE_ZONE = "America/Los_Angeles"
GOOGLE_ACCOUNT = "Merchant Account"
FX_COLUMNS = ["rate_date", "currency", "usd_rate", "published_at"]
FEE_SCHEDULE_COLUMNS = ["psp", "account", "valid_from", "percent_fee", "fixed_fee", "fixed_fee_currency"]


@dataclass(frozen=True)
class Inputs:
    """Where the snapshots lie: a path, a glob or a list of paths each.

    The Google Play reports do not name their merchant account, so it is an input.
    `multiline` lists snapshots whose quoted fields hold line breaks; each of their files
    is read by one task. `google_title` is a pattern of title lines; without it a file's first
    line is its title.
    """

    engine: str
    paypal_us: str
    paypal_eu: str
    dlocal: str
    adyen: str
    google_play: Sequence[str]
    fx_rates: str
    fee_schedule: str
    google_account: str = "LumoPlayMain"
    google_title: str | None = None
    multiline: Sequence[str] = ()

    def all_paths(self) -> list[str]:
        single = [self.engine, self.paypal_us, self.paypal_eu, self.dlocal, self.adyen]
        return [*single, *self.google_play, self.fx_rates, self.fee_schedule]


def read_raw(spark: SparkSession, inputs: Inputs) -> dict[str, DataFrame]:
    """All snapshots as text."""

    def read(name: str, columns: Sequence[str], **options) -> DataFrame:
        return read_snapshot(spark, getattr(inputs, name), columns, multiline=name in inputs.multiline, **options)

    google = read_titled_snapshot(spark, inputs.google_play, GOOGLE_COLUMNS, inputs.google_title)
    return {
        "engine": read("engine", ENGINE_COLUMNS, lineage=False),
        "paypal_us": read("paypal_us", PAYPAL_COLUMNS),
        "paypal_eu": read("paypal_eu", PAYPAL_COLUMNS, sep=";", encoding="cp1252"),
        "dlocal": read("dlocal", DLOCAL_COLUMNS),
        "adyen": read("adyen", ADYEN_COLUMNS),
        "google_play": google.withColumn(GOOGLE_ACCOUNT, F.lit(inputs.google_account)),
        "fx_rates": read("fx_rates", FX_COLUMNS, lineage=False),
        "fee_schedule": read("fee_schedule", FEE_SCHEDULE_COLUMNS, lineage=False),
    }


# -- staging ------------------------------------------------------------------------


def stage_engine(df: DataFrame) -> DataFrame:
    """Strict types; every row is kept."""
    types = {
        "amount_local": MONEY,
        "fx_rate_applied": RATE,
        "fx_date_applied": "date",
        "amount_usd": MONEY,
        "created_at_utc": "timestamp",
        "captured_at_utc": "timestamp",
    }
    return df.select(*(F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in ENGINE_COLUMNS))


def _stage_paypal(df: DataFrame, number, clock) -> DataFrame:
    return drop_exact_copies(df).select(
        raw("Transaction ID").alias("transaction_id"),
        raw("Reference Txn ID").alias("reference_txn_id"),
        raw("Invoice ID").alias("invoice_id"),
        raw("Type").alias("transaction_type"),
        raw("Status").alias("status"),
        raw("Name").alias("payer_name"),
        raw("Currency").alias("currency"),
        *(number(raw(c)).alias(f"{c.lower()}_amount") for c in ("Gross", "Fee", "Net")),
        times.to_utc(clock, raw("Time Zone")).alias("event_timestamp_utc"),
        SOURCE_FILE,
    )


def stage_paypal_us(df: DataFrame) -> DataFrame:
    return _stage_paypal(df, tolerant, times.local_clock(times.joined("Date", "Time"), times.MONTH_FIRST))


def stage_paypal_eu(df: DataFrame) -> DataFrame:
    """Decimal commas; the day order of a date follows from the interval in the file name."""
    interval = times.interval_of_file(F.col(SOURCE_FILE))
    return _stage_paypal(df, decimal_comma, times.day_or_month_first(times.joined("Date", "Time"), *interval))


def stage_dlocal(df: DataFrame) -> DataFrame:
    """Integer minor units become major units."""
    kept = "transaction_id invoice_id transaction_type status country currency".split()
    return drop_exact_copies(df).select(
        *kept,
        times.local_clock(F.col("created_at_utc"), times.ISO_SPACED).alias("event_timestamp_utc"),
        F.col("currency_exponent").try_cast("smallint").alias("currency_exponent"),
        minor_to_major("local_amount", "currency_exponent").alias("local_amount"),
        tolerant("fx_rate", RATE).alias("fx_rate"),
        tolerant("usd_amount").alias("usd_amount"),
        tolerant("fee_usd").alias("fee_usd"),
        SOURCE_FILE,
    )


ADYEN_AMOUNTS = ["Gross Debit", "Gross Credit", "Commission", "Markup", "Net Debit", "Net Credit"]


def stage_adyen(df: DataFrame) -> DataFrame:
    """Debit and credit registers stay apart; each row names its zone."""
    kept = [c for c in ADYEN_COLUMNS if c not in {*ADYEN_AMOUNTS, "Creation Date", "TimeZone"}]
    return drop_exact_copies(df).select(
        *(raw(c).alias(_snake(c)) for c in kept),
        times.to_utc(times.local_clock(raw("Creation Date"), times.ISO_SPACED), raw("TimeZone")).alias(
            "event_timestamp_utc"
        ),
        *(tolerant(raw(c)).alias(_snake(c)) for c in ADYEN_AMOUNTS),
        SOURCE_FILE,
    )


def stage_google_play(df: DataFrame) -> DataFrame:
    """All rows are kept: without event IDs equal rows are not proven copies."""
    clock = times.local_clock(times.joined("Transaction Date", "Transaction Time"), times.MONTH_NAME)
    return df.select(
        F.to_utc_timestamp(clock, GOOGLE_ZONE).alias("event_timestamp_utc"),
        raw("Transaction Type").alias("transaction_type"),
        raw("Product ID").alias("product_id"),
        raw("Buyer Country").alias("buyer_country"),
        raw("Buyer Currency").alias("buyer_currency"),
        tolerant(raw("Amount (Buyer Currency)")).alias("buyer_amount"),
        tolerant(raw("Currency Conversion Rate"), RATE).alias("currency_conversion_rate"),
        raw("Merchant Currency").alias("merchant_currency"),
        tolerant(raw("Amount (Merchant Currency)")).alias("merchant_amount"),
        raw(GOOGLE_ACCOUNT).alias("merchant_account"),
        SOURCE_FILE,
    )


def stage_fx_rates(df: DataFrame) -> DataFrame:
    """Strict types; rows equal after typing are one."""
    return drop_typed_copies(
        df,
        F.col("rate_date").cast("date").alias("rate_date"),
        F.col("currency"),
        F.col("usd_rate").cast(RATE).alias("usd_rate"),
        F.col("published_at").cast("timestamp").alias("published_at"),
    )


def stage_fee_schedule(df: DataFrame) -> DataFrame:
    """Strict types; rows equal after typing are one."""
    return conform(df, TARIFF).distinct()


STAGES = {
    "engine": stage_engine,
    "paypal_us": stage_paypal_us,
    "paypal_eu": stage_paypal_eu,
    "dlocal": stage_dlocal,
    "adyen": stage_adyen,
    "google_play": stage_google_play,
    "fx_rates": stage_fx_rates,
    "fee_schedule": stage_fee_schedule,
}


def _snake(name: str) -> str:
    return name.lower().replace(" ", "_")


# -- event, fee and match specs -----------------------------------------------------

_PAYPAL_EVENT_COLUMNS = {
    "source_file": "source_file",
    "psp_reference": "transaction_id",
    "parent_psp_reference": "reference_txn_id",
    "order_id": "invoice_id",
    "event_timestamp_utc": "event_timestamp_utc",
    "currency": "currency",
}

# Source types and statuses and what they mean.
EVENT_SPECS = {
    "paypal_us": EventSpec(
        psp="paypal_us",
        kind="transaction_type",
        operations={"Website Payment": "SALE", "Refund": "REFUND"},
        operation_default="OTHER",
        status="status",
        statuses={"Completed": "settled", "Refunded": "settled", "Denied": "declined"},
        status_default="unknown",
        financial={
            ("Website Payment", "Completed"): True,
            ("Refund", "Refunded"): True,
            ("Website Payment", "Denied"): False,
        },
        event_id="transaction_id",
        amount="gross_amount",
        amount_usd_reported="IF(currency = 'USD', _amount, NULL)",
        columns=_PAYPAL_EVENT_COLUMNS,
    ),
    "paypal_eu": EventSpec(
        psp="paypal_eu",
        kind="transaction_type",
        operations={"Website Payment": "SALE", "Refund": "REFUND", "Payment Reversal": "REVERSAL"},
        operation_default="OTHER",
        status="status",
        statuses={"Completed": "settled", "Refunded": "settled", "Reversed": "settled", "Denied": "declined"},
        status_default="unknown",
        financial={
            ("Website Payment", "Completed"): True,
            ("Refund", "Refunded"): True,
            ("Payment Reversal", "Reversed"): True,
            ("Website Payment", "Denied"): False,
        },
        event_id="transaction_id",
        amount="gross_amount",
        columns=_PAYPAL_EVENT_COLUMNS,
    ),
    "dlocal": EventSpec(
        psp="dlocal",
        kind="transaction_type",
        operations={"PAYMENT": "SALE", "REFUND": "REFUND"},
        operation_default="OTHER",
        status="status",
        statuses={"PAID": "settled", "REFUNDED": "settled", "REJECTED": "declined", "IN_MEDIATION": "disputed"},
        status_default="unknown",
        financial={
            ("PAYMENT", "PAID"): True,
            ("REFUND", "REFUNDED"): True,
            ("PAYMENT", "REJECTED"): False,
            ("PAYMENT", "IN_MEDIATION"): False,
        },
        negative=("REFUND",),
        event_id="transaction_id",
        amount="local_amount",
        amount_usd_reported="IF(_operation = 'REFUND', -usd_amount, usd_amount)",
        columns={
            "source_file": "source_file",
            "psp_reference": "transaction_id",
            "order_id": "invoice_id",
            "event_timestamp_utc": "event_timestamp_utc",
            "country": "country",
            "currency": "currency",
            # Quoted as local currency per USD; the contract wants USD per local unit.
            "fx_rate_reported": lambda: invert_rate("fx_rate"),
        },
    ),
    "adyen": EventSpec(
        psp="adyen",
        kind="record_type",
        keep_only=("Settled", "Refused", "Refunded", "Chargeback"),
        operations={"Settled": "SALE", "Refused": "SALE", "Refunded": "REFUND", "Chargeback": "CHARGEBACK"},
        statuses={"Settled": "settled", "Refused": "declined", "Refunded": "settled", "Chargeback": "settled"},
        financial=by_kind({"Settled": True, "Refused": False, "Refunded": True, "Chargeback": True}),
        event_id=lambda: lifecycle_id(F.col("psp_reference"), F.col("_operation")),
        amount=lambda: from_registers(F.col("gross_credit"), F.col("gross_debit")),
        amount_usd_reported="IF(gross_currency = 'USD', _amount, NULL)",
        columns={
            "provider_account": "merchant_account",
            "source_file": "source_file",
            "psp_reference": "psp_reference",
            "parent_psp_reference": "IF(_operation IN ('REFUND', 'CHARGEBACK'), psp_reference, NULL)",
            "order_id": "merchant_reference",
            "event_timestamp_utc": "event_timestamp_utc",
            "currency": "gross_currency",
        },
    ),
    "google_play": EventSpec(
        psp="google_play",
        kind="transaction_type",
        keep_only=("Charge", "Charge refund"),
        operations={"Charge": "SALE", "Charge refund": "REFUND"},
        status_default="settled",
        financial=by_kind({"Charge": True, "Charge refund": True}),
        event_id=lambda: attribute_id(
            F.col("event_timestamp_utc"),
            F.col("transaction_type"),
            F.col("product_id"),
            F.col("buyer_country"),
            F.col("buyer_currency"),
        ),
        amount="buyer_amount",
        amount_usd_reported="merchant_amount",
        columns={
            "provider_account": "merchant_account",
            "source_file": "source_file",
            "event_timestamp_utc": "event_timestamp_utc",
            "country": "buyer_country",
            "sku": "product_id",
            "currency": "buyer_currency",
            "fx_rate_reported": "currency_conversion_rate",
        },
    ),
}

FEE_SPECS = {
    "paypal_us": FeeSpec("paypal_us", "transaction_id", "currency", {"total": "-fee_amount"}),
    "paypal_eu": FeeSpec("paypal_eu", "transaction_id", "currency", {"total": "-fee_amount"}),
    "dlocal": FeeSpec("dlocal", "transaction_id", "'USD'", {"total": "fee_usd"}),
    "adyen": FeeSpec(
        "adyen",
        "concat(psp_reference, ':sale')",
        "net_currency",
        {"commission": "commission", "markup": "markup"},
        account="merchant_account",
        where="record_type = 'Settled'",
    ),
    "google_play": FeeSpec(
        "google_play",
        "charge_event_id",
        "merchant_currency",
        {"total": "-merchant_amount"},
        account="merchant_account",
    ),
}

# Fee rows without IDs: linked to the one charge that shares these attributes.
GOOGLE_FEE_KIND = "Google fee"
GOOGLE_FEE_LINK = [
    ("event_timestamp_utc", "event_timestamp_utc"),
    ("product_id", "sku"),
    ("buyer_country", "country"),
    ("buyer_currency", "currency"),
    ("currency_conversion_rate", "fx_rate_reported"),
    ("source_file", "source_file"),
]

MATCH_RULES = [
    MatchRule("psp_reference", ["psp", "psp_reference"], psps=("paypal_us", "paypal_eu", "dlocal")),
    MatchRule("psp_reference", ["psp", "psp_reference"], psps=("adyen",), provider_operations=("SALE",)),
    MatchRule(
        "order_and_operation",
        ["psp", "order_id", "operation_type"],
        psps=("adyen",),
        provider_operations=("REFUND", "CHARGEBACK"),
    ),
    MatchRule(
        "timestamp_and_attributes",
        ["psp", "event_timestamp_utc", "operation_type", "sku", "country", "currency"],
        psps=("google_play",),
        one_to_one=True,
    ),
]
