"""Ledgers, rates, tariffs and fees derived from the given tables.

Both ledgers describe the same orders; rules on the order key plant every kind of
difference, so that each cause and each check has rows to find.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from crosstally.operators.adapters import (
    EventSpec,
    FeeSpec,
    by_kind,
    engine_events,
    provider_events,
    provider_fees,
    union_events,
)
from crosstally.operators.asof import value_in_usd
from crosstally.operators.contracts import FX_RATE, TARIFF, conform
from crosstally.operators.matching import MatchRule
from crosstally.session import pin_utc

MONTH = date(2026, 6, 1)
FEE_MONTHS = [date(2026, 5, 1), date(2026, 6, 1), date(2026, 7, 1)]

RULE = MatchRule("psp_reference", ["psp", "psp_reference"])

_CURRENCY = "CASE n_nationkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'BRL' END"
_RATE = "CAST(CASE n_nationkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.1 WHEN 2 THEN 1.3 ELSE 0.2 END AS DECIMAL(17,10))"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read for the schema once per process."""
    pin_utc(spark)
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: key, amount, currency and the true operation, time and status."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        "o_orderkey AS k",
        "n_nationkey AS n",
        "n_name AS country",
        "concat('psp_', o_orderkey % 3) AS psp",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
        f"{_CURRENCY} AS currency",
        f"{_RATE} AS rate",
        "TIMESTAMP '2026-05-16 12:00:00' + make_dt_interval(CAST(o_orderkey % 61 AS INT)) AS ts",
        "CASE WHEN o_orderkey % 5 = 1 THEN 'REFUND' WHEN o_orderkey % 7 = 2 THEN 'CHARGEBACK' ELSE 'SALE' END AS op",
        "CASE WHEN o_orderstatus <> 'P' THEN 'settled' WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'declined' END"
        " AS status",
    )


def engine_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The internal ledger as staged: unsigned amounts, cents in USD. Lacks some orders."""
    return base(spark, sf_dir).filter("k % 11 <> 3").selectExpr(
        "concat('E', k) AS txn_id",
        "concat('O', k) AS order_id",
        "op AS operation_type",
        "status",
        "psp",
        "concat('R', k) AS psp_reference",
        "concat('sku_', k % 7) AS sku",
        "country",
        "currency",
        "CAST(amount AS DECIMAL(20,8)) AS amount_local",
        "CAST(rate AS DECIMAL(18,10)) AS fx_rate_applied",
        "CAST(ts AS DATE) AS fx_date_applied",
        "CAST(round(amount * rate, 2) AS DECIMAL(20,8)) AS amount_usd",
        "ts - INTERVAL '1' HOUR AS created_at_utc",
        "IF(status = 'settled', ts, NULL) AS captured_at_utc",
    )


def engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine_events(engine_ledger(spark, sf_dir))


# The provider's own vocabulary and what it means.
PROVIDER_SPEC = EventSpec(
    psp=None,
    kind="kind",
    operations={"Payment": "SALE", "Refund": "REFUND", "Reversal": "REVERSAL", "Chargeback": "CHARGEBACK"},
    operation_default="OTHER",
    status="state",
    statuses={"PAID": "settled", "OPEN": "pending", "REFUSED": "declined", "IN_DISPUTE": "disputed"},
    status_default="unknown",
    financial={
        **{(kind, "PAID"): True for kind in ("Payment", "Refund", "Reversal", "Chargeback")},
        **{
            (kind, state): False
            for kind in ("Payment", "Refund", "Reversal", "Chargeback")
            for state in ("OPEN", "REFUSED", "IN_DISPUTE")
        },
    },
    event_id="concat('P', k)",
    amount="amount",
    amount_usd_reported="amount_usd",
    columns={
        "psp": "psp",
        "provider_account": "concat('acct_', n)",
        "source_file": "concat('feed_', k % 3, '.csv')",
        "psp_reference": "concat('R', k)",
        "order_id": "concat('O', k)",
        "event_timestamp_utc": "ts",
        "country": "country",
        "sku": "concat('sku_', k % 7)",
        "currency": "currency",
        "fx_rate_reported": "quoted_rate",
    },
)


def provider_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provider's rows as staged: signed amounts, its own type and state names."""
    local = "CAST(IF(op = 'SALE', 1, -1) * (amount - IF(k % 31 = 6, 1.00, 0.00)) AS DECIMAL(18,2))"
    value = f"{local} * IF(k % 29 = 7, quoted_rate, rate)"
    return (
        base(spark, sf_dir)
        .filter("k % 13 <> 5")
        .withColumn("quoted_rate", F.expr("IF(k % 29 = 7, CAST(rate * 1.01 AS DECIMAL(17,10)), NULL)"))
        .selectExpr(
            "k",
            "n",
            "psp",
            "country",
            "currency",
            "quoted_rate",
            """CASE WHEN k % 11 = 3 AND k % 4 = 3 THEN 'Reversal' WHEN k % 43 = 5 THEN 'Adjustment'
            WHEN op = 'REFUND' THEN 'Refund' WHEN op = 'CHARGEBACK' THEN 'Chargeback' ELSE 'Payment' END AS kind""",
            """CASE WHEN k % 37 = 4 THEN 'IN_DISPUTE' WHEN status = 'settled' THEN 'PAID'
            WHEN status = 'pending' THEN 'OPEN' ELSE 'REFUSED' END AS state""",
            "ts + make_dt_interval(IF(k % 41 = 9, 30, 0)) AS ts",
            f"CAST({local} AS DECIMAL(20,8)) AS amount",
            f"""CASE WHEN k % 23 = 8 THEN CAST(round({value}, 2) + 0.01 AS DECIMAL(20,8))
            WHEN k % 29 = 7 THEN CAST({value} AS DECIMAL(20,8)) END AS amount_usd""",
        )
    )


def provider_unvalued(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provider_events(provider_feed(spark, sf_dir), PROVIDER_SPEC)


# -- three providers with conventions of their own ----------------------------------

_COMMON = {
    "source_file": "concat('feed_', k % 3, '.csv')",
    "psp_reference": "concat('R', k)",
    "order_id": "concat('O', k)",
    "event_timestamp_utc": "ts",
    "currency": "currency",
}

# Unsigned amounts; the operation gives the sign.
UNSIGNED_SPEC = EventSpec(
    psp="unsigned",
    kind="op",
    operations={"SALE": "SALE", "REFUND": "REFUND"},
    operation_default="OTHER",
    status="status",
    statuses={"settled": "settled", "pending": "pending", "declined": "declined"},
    financial={("SALE", "settled"): True, ("REFUND", "settled"): True, ("SALE", "declined"): False},
    negative=("REFUND",),
    amount="CAST(amount AS DECIMAL(20,8))",
    amount_usd_reported="CAST(IF(currency = 'USD', _amount, NULL) AS DECIMAL(20,8))",
    event_id="concat('U', k)",
    columns=_COMMON,
)
# A credit and a debit register, one reference for several operations, open states listed too.
REGISTER_SPEC = EventSpec(
    psp="register",
    kind="kind",
    operations={"Settled": "SALE", "Refunded": "REFUND", "Chargeback": "CHARGEBACK", "Refused": "SALE"},
    statuses={"Settled": "settled", "Refunded": "settled", "Chargeback": "settled", "Refused": "declined"},
    financial=by_kind({"Settled": True, "Refunded": True, "Chargeback": True, "Refused": False}),
    keep_only=("Settled", "Refunded", "Chargeback", "Refused"),
    amount="ifnull(credit, -debit)",
    amount_usd_reported="CAST(IF(currency = 'USD', _amount, NULL) AS DECIMAL(20,8))",
    event_id="concat('R', k, ':', lower(_operation))",
    columns=_COMMON | {"provider_account": "concat('acct_', n)"},
)
# Signed amounts; money-back rows name the sale that they undo.
SIGNED_SPEC = EventSpec(
    psp="signed",
    kind="op",
    operations={"SALE": "SALE", "REFUND": "REFUND", "CHARGEBACK": "REVERSAL"},
    status="status",
    statuses={"settled": "settled", "declined": "declined"},
    status_default="unknown",
    financial={(op, "settled"): True for op in ("SALE", "REFUND", "CHARGEBACK")},
    amount="signed_amount",
    event_id="concat('S', k)",
    columns=_COMMON | {"parent_psp_reference": "parent", "country": "country"},
)
TOTAL_FEE_SPEC = FeeSpec(
    psp="signed", event_id="concat('S', k)", currency="currency", components={"total": "-fee"}, where="op = 'SALE'"
)


def register_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        base(spark, sf_dir)
        .filter("k % 3 = 1")
        .selectExpr(
            "*",
            "CASE WHEN status = 'pending' THEN 'Authorised' WHEN status = 'declined' THEN 'Refused'"
            " WHEN op = 'SALE' THEN 'Settled' WHEN op = 'REFUND' THEN 'Refunded' ELSE 'Chargeback' END AS kind",
            "CAST(IF(op = 'SALE', amount, NULL) AS DECIMAL(20,8)) AS credit",
            "CAST(IF(op = 'SALE', NULL, amount) AS DECIMAL(20,8)) AS debit",
        )
    )


def signed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        base(spark, sf_dir)
        .filter("k % 3 = 2")
        .selectExpr(
            "*",
            "CAST(IF(op = 'SALE', amount, -amount) AS DECIMAL(20,8)) AS signed_amount",
            "IF(op = 'SALE', NULL, concat('R', k - 3)) AS parent",
            "CAST(-round(amount * 0.029, 2) AS DECIMAL(20,8)) AS fee",
            "concat('feed_', k % 3, '.csv') AS source_file",
        )
    )


def multi_provider_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the three providers in one contract."""
    return union_events(
        provider_events(base(spark, sf_dir).drop("psp").filter("k % 3 = 0"), UNSIGNED_SPEC),
        provider_events(register_feed(spark, sf_dir).drop("psp"), REGISTER_SPEC),
        provider_events(signed_feed(spark, sf_dir).drop("psp", "source_file"), SIGNED_SPEC),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate feed with one dated quote per nation; the last quote of a currency is its true rate."""
    nation = table(spark, sf_dir, "nation")
    return conform(
        nation.selectExpr(
            "date_add(DATE '2026-01-01', n_nationkey) AS rate_date",
            f"{_CURRENCY} AS currency",
            f"CAST({_RATE} * (1 + floor((24 - n_nationkey) / 4) * 0.001) AS DECIMAL(18,10)) AS usd_rate",
            "CAST(date_add(DATE '2026-01-01', n_nationkey) AS TIMESTAMP) AS published_at",
        ),
        FX_RATE,
    )


def provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider events valued in USD."""
    return value_in_usd(provider_unvalued(spark, sf_dir), rates(spark, sf_dir))


# -- rate feed with real revisions --------------------------------------------------


def rate_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revised quotes: signup events; the user decides the currency."""
    events = table(spark, sf_dir, "events")
    return events.filter("event_type = 'signup' AND user_id % 5 <> 4").selectExpr(
        "CAST(ts AS DATE) AS rate_date",
        "concat('C', user_id % 5) AS currency",
        "CAST(1 + CAST(value AS DECIMAL(18,2)) / 1000 AS DECIMAL(18,10)) AS usd_rate",
        "CAST(ts AS TIMESTAMP) AS published_at",
        "event_id",
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as unvalued provider events, some of them with reported USD."""
    events = table(spark, sf_dir, "events")
    return events.filter("event_type = 'purchase'").selectExpr(
        "concat('V', event_id) AS provider_event_id",
        "'shop' AS psp",
        "IF(user_id % 5 = 4, 'USD', concat('C', user_id % 5)) AS currency",
        "CAST(ts AS TIMESTAMP) AS event_timestamp_utc",
        "CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(20,8)) AS amount_local_signed",
        "CAST(IF(event_id % 10 = 3, CAST(value AS DECIMAL(18,2)), NULL) AS DECIMAL(20,8)) AS amount_usd_reported",
        "true AS is_financial_event",
    )


# -- tariffs and fees ---------------------------------------------------------------


def tariffs(spark: SparkSession, sf_dir: str, first_day: str, region_days: int, step_days: int) -> DataFrame:
    """Six tariffs per nation, taking effect one after the other."""
    nation = table(spark, sf_dir, "nation")
    steps = nation.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(5))))
    return conform(
        steps.selectExpr(
            "concat('psp_', n_nationkey % 3) AS psp",
            "concat('acct_', n_nationkey) AS account",
            f"date_add(DATE '{first_day}', n_regionkey * {region_days} + j * {step_days}) AS valid_from",
            "CAST(1 + ((n_nationkey + j) % 7) * 0.25 AS DECIMAL(18,10)) AS percent_fee",
            "CAST((j % 2) * 0.30 AS DECIMAL(20,8)) AS fixed_fee",
            "IF(j % 2 = 1, 'USD', NULL) AS fixed_fee_currency",
        ),
        TARIFF,
    )


def fee_tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tariffs(spark, sf_dir, "2026-05-01", 5, 12)


def fee_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valued events of accounts that tariffs cover."""
    return base(spark, sf_dir).selectExpr(
        "concat('P', k) AS provider_event_id",
        "concat('psp_', n % 3) AS psp",
        "concat('acct_', n) AS provider_account",
        "op AS operation_type",
        "status",
        "status = 'settled' AS is_financial_event",
        "ts AS event_timestamp_utc",
        "currency",
        "CAST(amount AS DECIMAL(20,8)) AS amount_local_signed",
        "CAST(rate AS DECIMAL(18,10)) AS fx_rate_selected",
        "CAST(amount * rate AS DECIMAL(38,18)) AS amount_usd_normalized",
    )


FEE_SPEC = FeeSpec(
    psp="fees",
    event_id="concat('P', k)",
    currency="fee_currency",
    components={"commission": "commission", "markup": "markup"},
    account="concat('acct_', n)",
    where="status = 'settled'",
)


def fee_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fee components per settled order, charged locally or in USD; some orders lack theirs."""
    staged = (
        base(spark, sf_dir)
        .filter("k % 53 <> 11")
        .selectExpr(
            "k",
            "n",
            "status",
            "IF(k % 2 = 0, currency, 'USD') AS fee_currency",
            "concat('fees_', k % 3, '.csv') AS source_file",
            "CAST(amount * IF(k % 2 = 0, CAST(1 AS DECIMAL(17,10)), rate) AS DECIMAL(28,12)) AS principal",
        )
        .selectExpr(
            "*",
            "CAST(round(principal * 0.01, 2) AS DECIMAL(20,8)) AS commission",
            "CAST(round(principal * 0.0175, 2) - round(principal * 0.01, 2) AS DECIMAL(20,8)) AS markup",
        )
    )
    fees = provider_fees(staged, FEE_SPEC)
    return fees.withColumn("psp", F.expr("concat('psp_', CAST(substring(provider_account, 6) AS INT) % 3)"))


def comparable(df: DataFrame, digits: Mapping[str, int] | None = None, default: int = 2) -> DataFrame:
    """Neutral column types for comparison across engines.

    Decimals are rounded to `digits` places (`default` if not named) and shown as
    doubles, dates and times as ISO text.
    """
    digits = digits or {}
    columns = []
    for name, dtype in df.dtypes:
        value = name
        if dtype.startswith("decimal"):
            scale = digits.get(name, default)
            value = f"CAST(CAST({name} AS DECIMAL({26 + scale},{scale})) AS DOUBLE)"
        elif dtype == "date":
            value = f"date_format({name}, 'yyyy-MM-dd')"
        elif dtype.startswith("timestamp"):
            value = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss')"
        elif dtype in ("int", "smallint"):
            value = f"CAST({name} AS BIGINT)"
        columns.append(f"{value} AS {name}")
    return df.selectExpr(*columns)
