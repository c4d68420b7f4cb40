"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from crosstally.functions import times
from crosstally.functions.decimals import (
    RATE,
    convert,
    decimal_comma,
    invert_rate,
    minor_to_major,
    percent_fee,
    tolerant,
)
from crosstally.operators import adapters, asof, copies, fees, matching, quality as q, reconcile as rec
from crosstally.plans import feeds, settlement
from crosstally.workloads import ledgers as lg
from crosstally.workloads.ledgers import FEE_MONTHS, MONTH, RULE, comparable, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- staging ------------------------------------------------------------------------


@query
def exact_copies(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang", "source")
    return copies.drop_exact_copies(docs).select(
        "lang", "source", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5")
    )


@query
def copy_conservation(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang", "source")
    staged = copies.drop_exact_copies(docs).agg(F.count(F.lit(1)).alias("staged_count"))
    counts = copies.copy_counts(docs).unionByName(staged, allowMissingColumns=True)
    return counts.agg(*(F.sum(c).alias(c) for c in ("raw_count", "excess_copies", "staged_count")))


@query
def typed_copies(spark, sf):
    """The same number is written with one, two or three digits; typing makes copies equal."""
    text = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag AS flag",
        "l_linestatus AS line_status",
        "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING) || CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN '0'"
        " ELSE '00' END AS quantity",
        "CAST(CAST(l_discount AS DECIMAL(18,2)) AS STRING) AS discount",
    )
    typed = copies.drop_typed_copies(
        text, F.col("flag"), F.col("line_status"), *(tolerant(c).alias(c) for c in ("quantity", "discount"))
    )
    return comparable(typed)


@query
def minor_units(spark, sf):
    text = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS STRING) AS minor",
        "CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE CAST(o_orderkey % 10 AS STRING) END AS exponent",
    )
    major = text.select("k", "exponent", minor_to_major("minor", "exponent").alias("major"))
    return comparable(major, {"major": 8})


def _price_text(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS plain",
        "replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), '.', ',') AS comma",
    ).selectExpr(
        "k",
        "CASE k % 19 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN '1,' || plain ELSE plain END AS plain",
        "CASE k % 19 WHEN 0 THEN NULL WHEN 1 THEN '-' WHEN 2 THEN '1.' || comma ELSE comma END AS comma",
    )


@query
def tolerant_cast(spark, sf):
    return comparable(_price_text(spark, sf).select("k", tolerant("plain").alias("amount")))


@query
def decimal_comma_numbers(spark, sf):
    return comparable(_price_text(spark, sf).select("k", decimal_comma("comma").alias("amount")))


@query
def check_parse_loss(spark, sf):
    text = _price_text(spark, sf)
    return q.all_checks(
        q.counted("plain", q.unparsed(text, {"plain": tolerant("plain")})),
        q.counted("comma", q.unparsed(text, {"comma": decimal_comma("comma")})),
    )


@query
def ambiguous_dates(spark, sf):
    """Odd keys are written day first, even ones month first; the file names its month."""
    text = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "date_format(o_orderdate, IF(o_orderkey % 2 = 1, 'dd/MM/yyyy', 'MM/dd/yyyy')) || ' 10:20:30' AS clock",
        "add_months(trunc(o_orderdate, 'MM'), IF(o_orderkey % 19 = 0, 24, 0)) AS first_day",
    ).selectExpr(
        "k",
        "clock",
        "concat('x_', date_format(first_day, 'yyyyMMdd'), '_', date_format(last_day(first_day), 'yyyyMMdd'), '.csv')"
        " AS source_file",
    )
    first, last = times.interval_of_file(F.col("source_file"))
    return comparable(text.select("k", times.day_or_month_first(F.col("clock"), first, last).alias("resolved")))


@query
def local_to_utc(spark, sf):
    """Reports in one fixed zone, month names and a separate time of day."""
    text = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "date_format(o_orderdate, 'MMM d, yyyy') AS day",
        "concat('0', 4 + o_orderkey % 6, ':', 10 + o_orderkey % 50, ':07') AS time",
    )
    clock = times.local_clock(times.joined("day", "time"), times.MONTH_NAME)
    return comparable(text.select("k", F.to_utc_timestamp(clock, "America/Los_Angeles").alias("utc")))


@query
def zone_by_row(spark, sf):
    """Each row names its zone; a token outside the allow-list gives NULL."""
    text = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "date_format(o_orderdate, 'yyyy-MM-dd') || ' 15:04:05' AS clock",
        "CASE o_orderkey % 6 WHEN 0 THEN 'PST' WHEN 1 THEN 'CET' WHEN 2 THEN 'UTC' WHEN 3 THEN 'Europe/London'"
        " WHEN 4 THEN 'Asia/Tokyo' ELSE 'PDT' END AS zone",
    )
    utc = times.to_utc(times.local_clock(F.col("clock"), times.ISO_SPACED), F.col("zone"))
    return comparable(text.select("k", "zone", utc.alias("utc")))


@query
def utc_text(spark, sf):
    """Text already in UTC, seconds kept; impossible dates give NULL."""
    text = table(spark, sf, "events").selectExpr(
        "event_id", "IF(event_id % 23 = 5, '2024-02-31 00:00:00', date_format(ts, 'yyyy-MM-dd HH:mm:ss')) AS clock"
    )
    return comparable(text.select("event_id", times.local_clock(F.col("clock"), times.ISO_SPACED).alias("utc")))


def _ledger_text(spark, sf):
    """The internal ledger as it arrives: text alone; every tenth row comes twice."""
    ledger = lg.engine_ledger(spark, sf).withColumn("copies", F.expr("IF(substr(txn_id, -1) = '0', 2, 1)"))
    ledger = ledger.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    clocks = ("created_at_utc", "captured_at_utc")
    return ledger.select(
        *(
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias(c) if c in clocks else F.col(c).cast("string").alias(c)
            for c in feeds.ENGINE_COLUMNS
        )
    )


@query
def keep_all_rows(spark, sf):
    """Staging without copy removal: equal rows of the ledger stay."""
    staged = feeds.stage_engine(_ledger_text(spark, sf))
    return staged.groupBy("operation_type", "status").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("txn_id").alias("transactions")
    )


@query
def strict_types(spark, sf):
    """Text to the ledger's types; unreadable text would fail the job."""
    staged = feeds.stage_engine(_ledger_text(spark, sf)).distinct()
    return comparable(
        staged.select("txn_id", "amount_local", "fx_rate_applied", "fx_date_applied", "amount_usd"),
        {"amount_local": 8, "fx_rate_applied": 6, "amount_usd": 8},
    )


@query
def zoned_times(spark, sf):
    """ISO times that name their offset become UTC."""
    staged = feeds.stage_engine(_ledger_text(spark, sf)).distinct()
    return comparable(staged.select("txn_id", "created_at_utc", "captured_at_utc"))


# -- exact numbers beyond one product -----------------------------------------------


@query
def convert_wide(spark, sf):
    """Rates up to the limit of their type; all 18 digits are compared."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "CAST(o_orderkey % 1000 + 0.12345678 AS DECIMAL(20,8)) AS amount",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * IF(o_orderkey % 2 = 0, 100, 0.01) + 0.0000000003 AS DECIMAL(18,10))"
        " AS rate",
    )
    return orders.select("k", convert("amount", "rate").cast("string").alias("value"))


@query
def fee_expected_wide(spark, sf):
    """Fees on converted principals above a billion, at rates with ten digits."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * IF(o_orderkey % 2 = 0, 2000000.00000001, 0.50000001)"
        " AS DECIMAL(38,18)) AS principal",
        "CAST(2.1234567891 + o_orderkey % 7 AS DECIMAL(18,10)) AS percent",
        "CAST(0.3 AS DECIMAL(20,8)) AS fixed",
    )
    fee = percent_fee(F.col("principal"), F.col("percent"), F.col("fixed"), wide=True)
    return orders.select("k", fee.cast("decimal(20,2)").cast("string").alias("fee"))


# -- canonical events ---------------------------------------------------------------


@query
def canonical_engine(spark, sf):
    return comparable(lg.engine(spark, sf), {"fx_rate_applied": 6})


@query
def canonical_provider(spark, sf):
    return comparable(lg.provider_unvalued(spark, sf), {"fx_rate_reported": 6, "amount_usd_reported": 6})


@query
def event_ids(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "concat('Charge ', event_type) AS kind", "IF(user_id % 7 = 0, NULL, user_id) AS u",
        "event_type", "event_id",
    )
    return events.select(
        "event_id",
        adapters.attribute_id(F.col("ts"), F.col("kind"), F.col("u").cast("string"), F.col("event_type")).alias(
            "attribute_id"
        ),
        adapters.lifecycle_id(F.col("u").cast("string"), F.upper("event_type")).alias("lifecycle_id"),
    )


@query
def financial_flags(spark, sf):
    events = lg.provider_unvalued(spark, sf)
    flag = F.coalesce(F.col("is_financial_event").cast("string"), F.lit("unsupported"))
    return events.groupBy("operation_type", "source_status", "status", flag.alias("financial")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


@query
def signed_amounts(spark, sf):
    events = lg.engine(spark, sf)
    return comparable(
        events.groupBy("psp", "operation_type").agg(
            F.count(F.lit(1)).alias("event_count"),
            F.sum("amount_local_signed").alias("amount_local"),
            F.sum("amount_usd_signed").alias("amount_usd"),
        )
    )


@query
def register_amounts(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "IF(l_returnflag <> 'R', CAST(l_extendedprice AS DECIMAL(18,2)), NULL) AS credit",
        "IF(l_returnflag = 'R', CAST(l_extendedprice AS DECIMAL(18,2)), NULL) AS debit",
    )
    amount = adapters.from_registers(F.col("credit"), F.col("debit"))
    return comparable(lines.groupBy("l_orderkey").agg(F.sum(amount).alias("amount")))


@query
def inverted_rates(spark, sf):
    quotes = lg.rate_feed(spark, sf).withColumn("quoted", F.expr("IF(event_id % 11 = 0, 0, usd_rate)").cast(RATE))
    return comparable(quotes.select("event_id", invert_rate("quoted").alias("inverted")), {"inverted": 8})


@query
def reported_usd(spark, sf):
    """USD as the provider reports it: only where the currency is USD, with the sign of the operation."""
    events = lg.multi_provider_events(spark, sf)
    return comparable(
        events.select("psp", "provider_event_id", "operation_type", "amount_local_signed", "amount_usd_reported")
    )


@query
def final_states(spark, sf):
    """A provider that lists open states too: final ones become events."""
    events = adapters.provider_events(lg.register_feed(spark, sf), lg.REGISTER_SPEC)
    return events.groupBy("source_status", "operation_type", "status").agg(F.count(F.lit(1)).alias("event_count"))


@query
def parent_references(spark, sf):
    events = lg.multi_provider_events(spark, sf)
    return events.select("psp", "provider_event_id", "parent_psp_reference")


@query
def event_union(spark, sf):
    """Three providers with different sign and type conventions in one contract."""
    events = lg.multi_provider_events(spark, sf)
    flag = F.coalesce(F.col("is_financial_event").cast("string"), F.lit("unsupported"))
    return comparable(
        events.groupBy("psp", "operation_type", "status", flag.alias("financial")).agg(
            F.count(F.lit(1)).alias("event_count"), F.sum("amount_local_signed").alias("amount")
        )
    )


# -- as-of --------------------------------------------------------------------------


@query
def latest_revision(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "user_id", "event_type", "CAST(ts AS DATE) AS day", "ts", "event_id", "value"
    )
    return comparable(
        asof.latest_revision(events, ["user_id", "event_type", "day"], ["ts", "event_id"]).drop("ts")
    )


def _selected_rates(spark, sf):
    feed = lg.rate_feed(spark, sf)
    return asof.latest_revision(feed, ["rate_date", "currency"], ["published_at", "event_id"])


def _rated_purchases(spark, sf):
    rates = _selected_rates(spark, sf).select("currency", "rate_date", "usd_rate")
    joined = asof.asof_join(
        lg.purchases(spark, sf),
        rates,
        [("currency", "currency")],
        F.col("event_timestamp_utc"),
        "rate_date",
    )
    return comparable(joined.select("provider_event_id", "currency", "rate_date", "usd_rate"), {"usd_rate": 8})


@query
def asof_left(spark, sf):
    return _rated_purchases(spark, sf)


@query
def asof_left_lookup(spark, sf):
    """The name it had when there were two forms."""
    return _rated_purchases(spark, sf)


@query
def usd_valuation(spark, sf):
    valued = asof.value_in_usd(lg.purchases(spark, sf), _selected_rates(spark, sf))
    return comparable(
        valued.select(
            "provider_event_id", "currency", "fx_date_selected", "fx_rate_selected", "amount_usd_normalized"
        ),
        {"fx_rate_selected": 8, "amount_usd_normalized": 8},
    )


def _order_events(spark, sf):
    return lg.base(spark, sf).join(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderdate"), "k"
    ).selectExpr(
        "k", "concat('psp_', n % 3) AS psp", "concat('acct_', n) AS provider_account",
        "CAST(o_orderdate AS TIMESTAMP) AS event_timestamp_utc",
    )


def _contracts(spark, sf):
    tariffs = lg.tariffs(spark, sf, "1995-01-01", 200, 365)
    found = asof.contract_in_force(_order_events(spark, sf), tariffs)
    return comparable(found.drop("event_timestamp_utc"), {"percent_fee": 4})


@query
def asof_inner(spark, sf):
    return _contracts(spark, sf)


@query
def asof_inner_lookup(spark, sf):
    """The name it had when there were two forms."""
    return _contracts(spark, sf)


@query
def asof_null_dates(spark, sf):
    """Quotes without a date or currency are in force nowhere; of two on one day the higher counts."""
    quotes = lg.rates(spark, sf).selectExpr(
        "IF(day(rate_date) % 5 = 0, NULL, IF(day(rate_date) % 3 = 0, date_sub(rate_date, 1), rate_date)) AS rate_date",
        "IF(day(rate_date) = 7, NULL, currency) AS currency",
        "usd_rate",
    )
    sales = lg.base(spark, sf).selectExpr(
        "k", "IF(k % 13 = 0, NULL, currency) AS paid_in",
        "IF(k % 17 = 0, NULL, date_add(DATE '2025-12-28', CAST(k % 40 AS INT))) AS day",
    )
    joined = asof.asof_join(sales, quotes, [("paid_in", "currency")], F.col("day"), "rate_date")
    return comparable(joined.select("k", "rate_date", "usd_rate"), {"usd_rate": 8})


# -- matching -----------------------------------------------------------------------


TWO_RULES = [
    matching.MatchRule("psp_reference", ["psp", "psp_reference"], provider_operations=("SALE",)),
    matching.MatchRule(
        "order_and_operation",
        ["psp", "order_id", "operation_type"],
        provider_operations=("REFUND", "CHARGEBACK"),
    ),
]
ALL_RULES = [
    matching.MatchRule("psp_reference", ["psp", "psp_reference"], psps=("psp_0",)),
    *(
        matching.MatchRule(r.method, r.keys, psps=("psp_1",), provider_operations=r.provider_operations)
        for r in TWO_RULES
    ),
    matching.MatchRule(
        "timestamp_and_attributes",
        ["psp", "event_timestamp_utc", "operation_type", "sku", "country", "currency"],
        psps=("psp_2",),
        one_to_one=True,
    ),
]
DAY_RULE = matching.MatchRule("user_and_day", ["psp", "day"], one_to_one=True)
CLICK_RULE = matching.MatchRule("user_and_day", ["psp", "day"])


def _clicks_and_views(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "event_id", "event_type", "CAST(user_id AS STRING) AS psp", "CAST(ts AS DATE) AS day"
    )
    clicks = events.filter("event_type = 'click'").selectExpr("concat('E', event_id) AS engine_txn_id", "psp", "day")
    views = events.filter("event_type = 'view'").selectExpr("concat('P', event_id) AS provider_event_id", "psp", "day")
    return clicks, views


@query
def match_reference(spark, sf):
    return matching.match(lg.engine(spark, sf), lg.provider_unvalued(spark, sf), RULE)


@query
def match_two_rules(spark, sf):
    return matching.match_all(lg.engine(spark, sf), lg.provider_unvalued(spark, sf), TWO_RULES)


@query
def match_unambiguous(spark, sf):
    return matching.match(*_clicks_and_views(spark, sf), DAY_RULE)


@query
def match_one_sided(spark, sf):
    """Reference rule on keys that repeat: all pairs of a key with a single row on either side."""
    return matching.match(*_clicks_and_views(spark, sf), CLICK_RULE)


@query
def match_repeated_keys(spark, sf):
    return matching.repeated_keys(*_clicks_and_views(spark, sf), [CLICK_RULE])


@query
def match_repeated_both(spark, sf):
    """The rows that a product would pair: their key repeats on both sides."""
    return matching.ambiguous_rows(*_clicks_and_views(spark, sf), [CLICK_RULE])


@query
def match_shared_ids(spark, sf):
    """Candidates that are alone under their key, but share an ID with another pair, match nothing."""
    clicks, views = _clicks_and_views(spark, sf)
    shared = clicks.withColumn("engine_txn_id", F.expr("concat('E', CAST(substr(engine_txn_id, 2) AS BIGINT) div 40)"))
    return matching.match(shared, views, DAY_RULE)


@query
def match_union(spark, sf):
    return matching.match_all(lg.engine(spark, sf), lg.provider_unvalued(spark, sf), ALL_RULES)


# -- payment reconciliation ---------------------------------------------------------


def _ledger_layers(spark, sf):
    """Both ledgers as written layers: several steps of a reconciliation read them."""
    keep = settlement.written_layers()
    sides = keep("ledgers", {"engine": lg.engine(spark, sf), "events": lg.provider(spark, sf)})
    return keep, sides["engine"], sides["events"]


def _two_sides(spark, sf):
    """Engine, valued events and matches."""
    keep, engine, events = _ledger_layers(spark, sf)
    return engine, events, keep("links", {"matches": matching.match(engine, events, RULE)})["matches"]


def _narrow_sides(spark, sf):
    """The same for queries of few columns: only the matches are kept."""
    engine, events = lg.engine(spark, sf), lg.provider(spark, sf)
    found = matching.match(engine, lg.provider_unvalued(spark, sf), RULE)
    return engine, events, settlement.written_layers()("links", {"matches": found})["matches"]


def _detail(spark, sf, months=(MONTH,)):
    return rec.reconcile(*_two_sides(spark, sf), list(months))


def _written_detail(spark, sf):
    """The detail as a layer, for checks that read it more than once."""
    return settlement.written_layers()("marts", {"detail": _detail(spark, sf)})["detail"]


@query
def pair_set(spark, sf):
    return rec.pair_set(*_narrow_sides(spark, sf)).select(
        "psp", "engine_txn_id", "provider_event_id", "match_method", "match_status"
    )


@query
def period_scope(spark, sf):
    scoped = rec.attribute_period(rec.pair_set(*_narrow_sides(spark, sf)), FEE_MONTHS)
    return comparable(
        scoped.select("report_month", "engine_txn_id", "provider_event_id", "engine_in_period", "provider_in_period")
    )


@query
def recon_detail(spark, sf):
    rates = dict.fromkeys(("engine_fx_rate", "provider_fx_rate_reported", "provider_fx_rate"), 6)
    values = dict.fromkeys(("provider_amount_usd_reported", "provider_amount_usd_normalized", "amount_usd_difference"), 6)
    return comparable(_detail(spark, sf), {**rates, **values})


@query
def recon_ambiguous(spark, sf):
    """References that repeat on both sides are unexplained, not missing; none is lost."""
    keep, engine, events = _ledger_layers(spark, sf)
    shared = F.expr("IF(psp_reference LIKE '%7', 'shared', psp_reference)")
    engine, events = (df.withColumn("psp_reference", shared) for df in (engine, events))
    links = keep("links", {"links": matching.link(engine, events, [RULE])})["links"]
    matches, unclear = matching.matches_of(links), matching.unclear_of(links)
    detail = rec.reconcile(engine, events, matches, [MONTH], ambiguous=unclear)
    return detail.groupBy("psp", "match_status", "cause").agg(F.count(F.lit(1)).alias("row_count"))


@query
def recon_cause_counts(spark, sf):
    return _detail(spark, sf).groupBy("cause").agg(F.count(F.lit(1)).alias("row_count"))


@query
def recon_summary(spark, sf):
    return comparable(rec.summarise(_detail(spark, sf)), {"absolute_impact_share_pct": 4})


@query
def recon_months(spark, sf):
    """Several report months in one pass."""
    return comparable(rec.cause_totals(_detail(spark, sf, FEE_MONTHS)))


@query
def recon_share(spark, sf):
    """Share of each provider and cause in the month's absolute impact; NULL if there is none."""
    detail = _written_detail(spark, sf)
    shares = rec.summarise(detail).select("psp", "cause", "absolute_impact_share_pct")
    quiet = rec.summarise(detail.filter("signed_usd_impact = 0")).selectExpr(
        "concat('quiet_', psp) AS psp", "cause", "absolute_impact_share_pct"
    )
    return comparable(shares.unionByName(quiet), {"absolute_impact_share_pct": 4})


@query
def recon_exceptions(spark, sf):
    return comparable(
        rec.exceptions(_detail(spark, sf)).select(
            "psp", "engine_txn_id", "provider_event_id", "match_status", "cause", "signed_usd_impact"
        )
    )


@query
def report_payment(spark, sf):
    detail = _detail(spark, sf)
    local = {"engine_amount_local": 8, "provider_amount_local": 8}
    return comparable(settlement.payment_exceptions_report(detail).projected(), local)


@query
def report_payment_summary(spark, sf):
    report = settlement.payment_summary_report(rec.summarise(_detail(spark, sf)))
    return comparable(report.projected(), {"absolute_impact_share_pct": 4})


# -- fees ---------------------------------------------------------------------------


def _line_components(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS k",
        "0 AS n",
        "'settled' AS status",
        "'USD' AS fee_currency",
        "'lines' AS source_file",
        "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(20,8))"
        " AS commission",
        "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(20,8))"
        " AS markup",
    )
    return adapters.provider_fees(lines, lg.FEE_SPEC)


@query
def fee_components(spark, sf):
    rows = _line_components(spark, sf)
    return comparable(
        rows.groupBy("provider_event_id", "fee_type").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("fee_amount").alias("fee_amount")
        )
    )


@query
def fee_reported(spark, sf):
    return comparable(fees.reported_fees(_line_components(spark, sf)))


@query
def fee_link(spark, sf):
    """Purchases linked to the one click of the same user and day."""
    events = table(spark, sf, "events").selectExpr("event_id", "event_type", "user_id", "CAST(ts AS DATE) AS day")
    charges = events.filter("event_type = 'click'").selectExpr("concat('C', event_id) AS click_id", "user_id AS u", "day AS d")
    rows = events.filter("event_type = 'purchase'").select("event_id", "user_id", "day")
    return fees.link_unique(rows, charges, [("user_id", "u"), ("day", "d")], "click_id", "linked").select(
        "event_id", "linked"
    )


@query
def total_fees(spark, sf):
    """A provider that reports one fee per event, as a negative amount."""
    rows = adapters.provider_fees(lg.signed_feed(spark, sf), lg.TOTAL_FEE_SPEC)
    return comparable(rows.select("psp", "provider_event_id", "fee_type", "currency", "fee_amount"))


@query
def fee_union(spark, sf):
    """Total and component fees in one contract."""
    rows = adapters.union_fees(
        adapters.provider_fees(lg.signed_feed(spark, sf), lg.TOTAL_FEE_SPEC),
        lg.fee_rows(spark, sf),
    )
    return comparable(
        rows.groupBy("psp", "fee_type", "currency").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("fee_amount").alias("fee_amount")
        )
    )


def _fee_detail(spark, sf):
    return fees.reconcile_fees(
        lg.fee_events(spark, sf), lg.fee_rows(spark, sf), lg.fee_tariffs(spark, sf), FEE_MONTHS
    )


@query
def fee_expected(spark, sf):
    """The fee each tariff in force asks of each sale, priced in the sale's currency."""
    scope = fees.fee_scope(lg.fee_events(spark, sf), lg.fee_tariffs(spark, sf), FEE_MONTHS)
    amount = percent_fee(F.abs("principal_amount_local"), F.col("percent_fee"), F.col("fixed_fee"))
    return comparable(
        scope.select("provider_event_id", "contract_valid_from", "percent_fee", amount.alias("expected_fee")),
        {"percent_fee": 4},
    )


@query
def fee_variance(spark, sf):
    detail = _fee_detail(spark, sf)
    return comparable(
        detail.select(
            "report_month", "psp", "provider_event_id", "provider_account", "fee_currency", "principal_currency",
            "contract_valid_from", "percent_fee", "fixed_fee", "reported_fee_local", "expected_fee_local",
            "signed_fee_variance_local", "reported_fee_usd", "expected_fee_usd", "signed_fee_variance_usd",
            "absolute_fee_variance_usd", "cause",
        ),
        {"percent_fee": 4},
    )


@query
def fee_summary(spark, sf):
    return comparable(fees.summarise_fees(_fee_detail(spark, sf)))


@query
def fee_exceptions(spark, sf):
    return comparable(
        rec.exceptions(_fee_detail(spark, sf)).select("provider_event_id", "fee_currency", "signed_fee_variance_usd")
    )


@query
def report_fee(spark, sf):
    return comparable(settlement.fee_exceptions_report(_fee_detail(spark, sf)).projected(), {"percent_fee": 4})


@query
def report_fee_summary(spark, sf):
    return comparable(settlement.fee_summary_report(fees.summarise_fees(_fee_detail(spark, sf))).projected())


# -- checks: each has inputs that pass and inputs that are broken on purpose ---------


@query
def check_columns(spark, sf):
    """NULL and accepted-value checks of whole tables, one aggregate each."""
    return q.all_checks(
        q.column_checks(
            lg.engine(spark, sf),
            "engine",
            ["engine_txn_id", "event_timestamp_utc", "is_financial_event"],
            {"operation_type": ["SALE", "REFUND", "CHARGEBACK"], "status": ["settled", "declined"]},
        ),
        q.column_checks(
            lg.provider_unvalued(spark, sf),
            "provider",
            ["provider_event_id", "is_financial_event", "amount_usd_reported"],
            {"operation_type": ["SALE", "REFUND", "REVERSAL", "CHARGEBACK"]},
        ),
    )


@query
def check_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    tariffs = lg.fee_tariffs(spark, sf)
    undated = tariffs.withColumn("valid_from", F.expr("IF(fixed_fee = 0, valid_from, NULL)"))
    return q.all_checks(
        q.counted("orders", q.repeated_rows(table(spark, sf, "orders"), ["o_orderkey"])),
        q.counted("lines", q.repeated_rows(lines, ["l_orderkey", "l_linenumber"])),
        q.counted("tariffs", q.repeated_rows(tariffs, ["psp", "account", "valid_from"], parts_required=True)),
        q.counted("undated", q.repeated_rows(undated, ["psp", "account", "valid_from"], parts_required=True)),
    )


@query
def check_conservation(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang", "source")
    staged = copies.drop_exact_copies(docs)
    return q.all_checks(
        q.counted("copies_removed", q.lost_rows(docs, staged)),
        q.counted("rows_missing", q.lost_rows(docs, staged.filter("lang <> 'en'"))),
        q.counted("all_kept", q.lost_rows(docs, docs, copies_removed=False)),
        q.counted("copies_not_kept", q.lost_rows(docs, staged, copies_removed=False)),
    )


@query
def check_per_file(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang", "source")
    return q.all_checks(
        q.counted("kept", q.lost_rows_per_group(docs, docs, "source")),
        q.counted("copies_dropped", q.lost_rows_per_group(docs, copies.drop_exact_copies(docs), "lang")),
    )


@query
def check_balance(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS gross",
        "IF(l_linenumber = 7, NULL, -round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2))"
        " AS fee",
        "round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_tax AS DECIMAL(4,2))), 2) AS net",
        "l_linestatus",
    )
    return q.all_checks(
        q.counted("open_lines", q.unbalanced(lines, ["gross", "fee"], "net", F.col("l_linestatus") == "O")),
        q.counted("gross_is_net", q.unbalanced(lines, ["gross"], "net", F.lit(True))),
    )


@query
def check_diff(spark, sf):
    """Provider events against what the source rows say, both directions."""
    events = lg.provider_unvalued(spark, sf)
    feed = lg.provider_feed(spark, sf)
    source = feed.selectExpr("concat('P', k) AS provider_event_id", "currency", "amount AS amount_local_signed")
    changed = source.withColumn(
        "amount_local_signed", F.expr("CAST(amount_local_signed + IF(currency = 'GBP', 0.01, 0) AS DECIMAL(20,8))")
    )
    key, values = ["provider_event_id"], ["currency", "amount_local_signed"]
    return q.all_checks(
        q.counted("same", q.differing_keys(source, events, key, values)),
        q.counted("changed", q.differing_keys(changed, events, key, values)),
        q.counted("missing", q.differing_keys(source, events.filter("status <> 'pending'"), key, values)),
    )


@query
def check_fee_source(spark, sf):
    fee_rows = lg.fee_rows(spark, sf)
    events = lg.fee_events(spark, sf)
    halved = fee_rows.withColumn("fee_amount", F.expr("IF(fee_type = 'markup', fee_amount * 2, fee_amount)").cast("decimal(20,8)"))
    return q.all_checks(
        q.counted("same", q.fee_differences(fee_rows, fee_rows, events)),
        q.counted("changed", q.fee_differences(halved, fee_rows, events)),
        q.counted("without_event", q.fee_differences(fee_rows, fee_rows, events.filter("operation_type = 'SALE'"))),
    )


@query
def check_totals(spark, sf):
    engine, events = lg.engine(spark, sf), lg.provider_unvalued(spark, sf)
    controls = {
        "records": ("count(1)", "count(1)"),
        "local": ("sum(amount_local_signed)", "sum(amount_local_signed)"),
        "sales": ("count_if(operation_type = 'SALE')", "count_if(operation_type = 'SALE')"),
    }
    unsigned = "sum(if(operation_type = 'SALE', amount_local, -amount_local))"
    from_ledger = controls | {"local": (unsigned, "sum(amount_local_signed)")}
    return q.all_checks(
        q.counted("same", q.control_totals(lg.engine_ledger(spark, sf), engine, from_ledger)),
        q.counted("different", q.control_totals(engine, events, controls)),
        q.counted("must_not_occur", q.must_not_occur(events, {"no_flag": "is_financial_event IS NULL", "no_id": "provider_event_id IS NULL"})),
    )


@query
def check_cardinality(spark, sf):
    """Match and event IDs: one clean rule, and one whose keys repeat."""
    clicks, views = _clicks_and_views(spark, sf)
    engine, events = lg.engine(spark, sf), lg.provider_unvalued(spark, sf)
    loose = matching.match(clicks, views, CLICK_RULE)
    twice = views.unionByName(views.filter("day = DATE '2024-01-02'"))
    return q.all_checks(
        q.counted("reference", q.match_key_problems(matching.match(engine, events, RULE), events)),
        q.counted("repeated", q.match_key_problems(loose, twice)),
    )


@query
def check_lifecycle(spark, sf):
    """Orders with open lines that have no finished line."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus")
    rows = q.unresolved(lines, "l_orderkey", "l_linestatus", ["O"], ["F"])
    return q.all_checks(q.counted("groups", rows), q.counted("open_rows", rows, "open_rows"))


@query
def check_match_rederive(spark, sf):
    keep, engine, events = _ledger_layers(spark, sf)
    actual = keep("links", {"matches": matching.match_all(engine, events, TWO_RULES)})["matches"]
    by_reference = matching.match(engine, events, RULE)
    return q.all_checks(
        q.counted("same", q.multiset_differences(matching.match_all(engine, events, TWO_RULES), actual), "excess"),
        q.counted("other_rule", q.multiset_differences(by_reference, actual), "excess"),
    )


@query
def check_fx_coverage(spark, sf):
    selected = _selected_rates(spark, sf)
    valued = asof.value_in_usd(lg.purchases(spark, sf), selected)
    future = valued.withColumn("fx_date_selected", F.expr("date_add(fx_date_selected, 3)"))
    return q.all_checks(
        q.counted("valued", q.valuation_gaps(valued)), q.counted("future_rates", q.valuation_gaps(future))
    )


@query
def check_scope(spark, sf):
    events, tariffs = lg.fee_events(spark, sf), lg.fee_tariffs(spark, sf)
    detail = fees.fee_scope(events, tariffs, FEE_MONTHS)
    return q.all_checks(
        q.counted("complete", q.fee_scope_differences(events, tariffs, detail, FEE_MONTHS)),
        q.counted("one_month_lost", q.fee_scope_differences(events, tariffs, detail.filter("report_month <> DATE '2026-06-01'"), FEE_MONTHS)),
    )


@query
def check_summary(spark, sf):
    detail = _fee_detail(spark, sf)
    summary = fees.summarise_fees(detail)
    fewer = detail.filter("principal_currency <> 'BRL'")
    return q.all_checks(
        q.counted("same", q.fee_summary_differences(detail, summary)),
        q.counted("rows_lost", q.fee_summary_differences(fewer, summary)),
    )


@query
def check_multiset(spark, sf):
    detail = _written_detail(spark, sf)
    summary = rec.summarise(detail)
    fewer = detail.filter("match_status <> 'engine_only'")
    return q.all_checks(
        q.counted("same", q.summary_differences(detail, summary), "excess"),
        q.counted("rows_lost", q.summary_differences(fewer, summary), "excess"),
    )


@query
def check_three_way(spark, sf):
    """Engine, provider and detail totals; unsupported events make a total unknown on both ends."""
    engine, events, matches = _two_sides(spark, sf)
    keep = settlement.written_layers()
    detail = keep("marts", {"detail": rec.reconcile(engine, events, matches, [MONTH])})["detail"]
    moved = detail.filter("cause <> 'cutoff_timing'")
    decided = events.withColumn("is_financial_event", F.expr("ifnull(is_financial_event, false)"))
    supported = rec.reconcile(engine, decided, matches, [MONTH])
    return q.all_checks(
        q.counted("supported", q.source_total_gaps(engine, decided, supported, [MONTH])),
        q.counted("unsupported", q.source_total_gaps(engine, events, detail, [MONTH])),
        q.counted("rows_lost", q.source_total_gaps(engine, events, moved, [MONTH])),
    )
