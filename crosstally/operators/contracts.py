"""Column contracts shared by all ledgers.

Principal is positive for sales and negative for refunds and chargebacks; a fee is
positive when it is an expense; a rate is USD per one unit of currency. Boolean flags
are three-valued: NULL means the source combination is not supported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from crosstally.functions.decimals import MONEY, RATE, USD


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


_T, _TS, _B, _D = StringType(), TimestampType(), BooleanType(), DateType()

ENGINE_EVENT = _struct(
    engine_txn_id=_T,
    psp=_T,
    psp_reference=_T,
    order_id=_T,
    operation_type=_T,
    status=_T,
    country=_T,
    sku=_T,
    currency=_T,
    fx_date_applied=_D,
    fx_rate_applied=RATE,
    amount_local_signed=MONEY,
    amount_usd_signed=USD,
    event_timestamp_utc=_TS,
    scope_timestamp_utc=_TS,
    is_financial_event=_B,
)

PROVIDER_EVENT = _struct(
    provider_event_id=_T,
    psp=_T,
    provider_account=_T,
    source_file=_T,
    psp_reference=_T,
    parent_psp_reference=_T,
    order_id=_T,
    operation_type=_T,
    source_status=_T,
    status=_T,
    event_timestamp_utc=_TS,
    country=_T,
    sku=_T,
    currency=_T,
    amount_local_signed=MONEY,
    amount_usd_reported=MONEY,
    fx_rate_reported=RATE,
    is_financial_event=_B,
)

VALUED_EVENT = StructType(
    [*PROVIDER_EVENT.fields, *_struct(fx_rate_selected=RATE, fx_date_selected=_D, amount_usd_normalized=USD).fields]
)

MATCH = _struct(psp=_T, engine_txn_id=_T, provider_event_id=_T, match_method=_T)

PROVIDER_FEE = _struct(
    provider_event_id=_T,
    psp=_T,
    provider_account=_T,
    fee_type=_T,
    currency=_T,
    fee_amount=MONEY,
    source_file=_T,
)

FX_RATE = _struct(rate_date=_D, currency=_T, usd_rate=RATE, published_at=_TS)

TARIFF = _struct(
    psp=_T, account=_T, valid_from=_D, percent_fee=RATE, fixed_fee=MONEY, fixed_fee_currency=_T
)


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Bring columns into contract order and type; contract columns the frame lacks are NULL."""
    have = set(df.columns)
    return df.selectExpr(
        *(f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in contract)
    )
