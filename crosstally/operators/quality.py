"""Data-quality checks. A check returns its violating rows; no rows means it passes.

Two-sided comparisons tag and union their inputs and count per group instead of
joining them, so that a repeated key costs rows, not pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

from crosstally.functions.decimals import USD, cents
from crosstally.operators.copies import copy_counts
from crosstally.operators.matching import ENGINE_ID, PROVIDER_ID
from crosstally.operators.reconcile import cause_totals, in_month
from crosstally.operators.skew import salted_join

_TOTAL = DecimalType(38, 8)


# -- results ------------------------------------------------------------------------


def counted(check: str, violating: DataFrame, weight: str | None = None) -> DataFrame:
    """(check, violations): the number of violating rows, or the sum of a weight column."""
    count = F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1))
    return violating.agg(count.cast("bigint").alias("violations")).select(F.lit(check).alias("check"), "violations")


def all_checks(*results: DataFrame) -> DataFrame:
    """One row per check."""
    return reduce(DataFrame.unionByName, results)


# -- one table ----------------------------------------------------------------------


def column_checks(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    rules: Mapping[str, Column] | None = None,
) -> DataFrame:
    """All NULL, accepted-value and row checks of a table in one aggregate."""
    return counts_of(df, column_counts(table, not_null, accepted, rules))


def column_counts(
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    rules: Mapping[str, Column] | None = None,
) -> dict[str, Column]:
    """Violations by check, as aggregates over a table.

    NULL is an accepted value. `rules` names conditions that no row may fulfil.
    """
    counts = {f"not_null:{table}.{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    for c, values in (accepted or {}).items():
        counts[f"accepted_values:{table}.{c}"] = F.count_if(~F.col(c).isin(*values))
    for name, broken in (rules or {}).items():
        counts[name] = F.count_if(broken)
    return counts


def counts_of(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """(check, violations) of a table in one aggregate."""
    slots = [f"c{i}" for i in range(len(counts))]
    row = df.agg(*(count.alias(slot) for slot, count in zip(slots, counts.values())))
    pairs = ", ".join(f"'{name}', {slot}" for slot, name in zip(slots, counts))
    return row.selectExpr(f"stack({len(slots)}, {pairs}) AS (check, violations)")


def repeated_rows(df: DataFrame, keys: Sequence[str], parts_required: bool = False) -> DataFrame:
    """Key values that occur more than once, or with a NULL part if parts are required."""
    bad = F.col("row_count") > 1
    if parts_required:
        bad = reduce(Column.__or__, (F.col(k).isNull() for k in keys), bad)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(bad)


def unparsed(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Rows where text that is there became NULL in parsing; NULL text is legitimate."""
    lost = (F.col("`" + c + "`").isNotNull() & value.isNull() for c, value in parsed.items())
    return df.filter(reduce(Column.__or__, lost))


def is_unbalanced(parts: Sequence[str], total: str, where: Column) -> Column:
    """Whether a row in scope has parts that do not add up to the total, or cannot be added."""
    added = reduce(Column.__add__, (F.col(p) for p in parts))
    unknown = reduce(Column.__or__, (F.col(c).isNull() for c in [*parts, total]))
    return where & (unknown | (added != F.col(total)))


def unbalanced(df: DataFrame, parts: Sequence[str], total: str, where: Column) -> DataFrame:
    """Rows in scope whose parts do not add up to the total, or cannot be added."""
    return df.filter(is_unbalanced(parts, total, where))


def unresolved(
    df: DataFrame, reference: str, kind: str, opened: Sequence[str], final: Sequence[str]
) -> DataFrame:
    """References with open rows but no final row, with the number of open rows."""
    groups = df.groupBy(reference).agg(
        F.count_if(F.col(kind).isin(*opened)).alias("open_rows"),
        F.count_if(F.col(kind).isin(*final)).alias("final_rows"),
    )
    return groups.filter((F.col("open_rows") > 0) & ((F.col("final_rows") == 0) | F.col(reference).isNull()))


#: What may be missing or wrong in the value of a financial event, by name.
VALUATION_RULES = {
    "no_amount": "amount_local_signed IS NULL",
    "no_value": "amount_usd_normalized IS NULL",
    "no_rate": "currency <> 'USD' AND fx_rate_selected IS NULL",
    "no_rate_date": "currency <> 'USD' AND fx_date_selected IS NULL",
    "rate_of_a_later_day": "fx_date_selected > to_date(event_timestamp_utc)",
}


def valuation_gap_names() -> Column:
    """Names of the valuation rules that a row breaks."""
    named = F.array(*(F.when(F.expr(rule), F.lit(name)) for name, rule in VALUATION_RULES.items()))
    return F.array_compact(named)


def has_valuation_gap() -> Column:
    return F.col("is_financial_event") & (F.size(valuation_gap_names()) > 0)


def valuation_gaps(events: DataFrame) -> DataFrame:
    """Financial events that break a valuation rule, with the names of those rules."""
    return events.filter(has_valuation_gap()).withColumn("gaps", valuation_gap_names())


# -- conservation -------------------------------------------------------------------


def lost_rows(raw: DataFrame, staged: DataFrame, copies_removed: bool = True) -> DataFrame:
    """One row if raw records are not staged records plus the excess copies."""
    if copies_removed:
        before = copy_counts(raw)
    else:
        before = raw.agg(F.count(F.lit(1)).alias("raw_count"), F.lit(0).cast("bigint").alias("excess_copies"))
    after = staged.agg(F.count(F.lit(1)).alias("staged_count"))
    both = before.unionByName(after, allowMissingColumns=True)
    totals = both.agg(*(F.sum(c).alias(c) for c in ("raw_count", "staged_count", "excess_copies")))
    return totals.filter("raw_count <> staged_count + excess_copies")


def lost_rows_per_group(raw: DataFrame, staged: DataFrame, by: str = "source_file") -> DataFrame:
    """Groups (files) whose raw and staged row counts differ."""
    tagged = raw.select(by, F.lit(1).alias("r"), F.lit(0).alias("s")).unionByName(
        staged.select(by, F.lit(0).alias("r"), F.lit(1).alias("s"))
    )
    counts = tagged.groupBy(by).agg(F.sum("r").alias("raw_count"), F.sum("s").alias("staged_count"))
    return counts.filter("raw_count <> staged_count")


# -- two tables ---------------------------------------------------------------------


def _side_counts(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    tagged = left.select(*columns, F.lit(True).alias("_left")).unionByName(
        right.select(*columns, F.lit(False).alias("_left"))
    )
    # The hash leads: where groups are sorted, the first eight bytes are compared at once.
    counts = tagged.withColumn("_hash", F.xxhash64(*columns)).groupBy("_hash", *columns).agg(
        F.count_if("_left").alias("left_rows"), F.count_if(~F.col("_left")).alias("right_rows")
    )
    return counts.drop("_hash")


def differing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Keys on one side only, keys whose columns differ (NULL equals NULL), keys with a NULL part.

    Repeated keys are for `repeated_rows` to find.
    """
    counts = _side_counts(left, right, [*keys, *columns])
    null_part = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    lonely = (F.col("left_rows") == 0) | (F.col("right_rows") == 0)
    return counts.filter(lonely | null_part).select(*keys).distinct()


def multiset_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides; `excess` is by how much."""
    counts = _side_counts(left, right, left.columns)
    return counts.withColumn("excess", F.abs(F.col("left_rows") - F.col("right_rows"))).filter("excess > 0")


def homeless_fees(fees: DataFrame, events: DataFrame) -> DataFrame:
    """(psp, provider_event_id) of fees that no event owns; a NULL ID has no owner."""
    key = ["psp", PROVIDER_ID]
    counts = _side_counts(fees, events, key)
    ownerless = (F.col("right_rows") == 0) | F.col(PROVIDER_ID).isNull()
    return counts.filter((F.col("left_rows") > 0) & ownerless).select(*key)


def fee_differences(expected: DataFrame, actual: DataFrame, events: DataFrame) -> DataFrame:
    """Events whose fee rows are not exactly the expected ones, and fees without an event."""
    shape = ["psp", PROVIDER_ID, "provider_account", "fee_type", "currency", "fee_amount"]
    wrong = multiset_differences(expected.select(*shape), actual.select(*shape)).select("psp", PROVIDER_ID)
    return wrong.unionByName(homeless_fees(actual, events)).distinct()


def control_totals(source: DataFrame, target: DataFrame, equal: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Controls whose SQL aggregate over the source differs from the one over the target."""

    def totals(df: DataFrame, exprs: Sequence[str], side: str) -> DataFrame:
        row = df.agg(*(F.expr(e).cast(USD).alias(f"c{i}") for i, e in enumerate(exprs)))
        pairs = ", ".join(f"'{name}', c{i}" for i, name in enumerate(equal))
        return row.selectExpr(f"stack({len(equal)}, {pairs}) AS (control, {side})")

    both = totals(source, [s for s, _ in equal.values()], "source").unionByName(
        totals(target, [t for _, t in equal.values()], "target"), allowMissingColumns=True
    )
    values = both.groupBy("control").agg(F.max("source").alias("source"), F.max("target").alias("target"))
    return values.filter(~F.col("source").eqNullSafe(F.col("target")))


def must_not_occur(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Conditions that hold for at least one row, with the number of rows."""
    row = df.agg(*(F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(conditions.values())))
    pairs = ", ".join(f"'{name}', c{i}" for i, name in enumerate(conditions))
    return row.selectExpr(f"stack({len(conditions)}, {pairs}) AS (control, row_count)").filter("row_count > 0")


# -- reconciliation invariants ------------------------------------------------------


def match_key_problems(matches: DataFrame, events: DataFrame) -> DataFrame:
    """IDs matched more than once on either side, and provider event IDs that repeat."""
    ids = matches.selectExpr(
        "psp", f"stack(2, 'engine_match', {ENGINE_ID}, 'provider_match', {PROVIDER_ID}) AS (key_type, key)"
    ).unionByName(events.select("psp", F.lit("provider_event_id").alias("key_type"), F.col(PROVIDER_ID).alias("key")))
    return repeated_rows(ids, ["key_type", "psp", "key"])


def fee_scope_differences(
    events: DataFrame, tariffs: DataFrame, detail: DataFrame, months: Sequence[date]
) -> DataFrame:
    """Covered sales of the months that the fee detail lacks, and detail rows that are none."""
    of_months = reduce(Column.__or__, (in_month("event_timestamp_utc", F.lit(m).cast("date")) for m in months))
    sales = events.filter("operation_type = 'SALE' AND status = 'settled' AND is_financial_event").filter(of_months)
    first = tariffs.select("psp", F.col("account").alias("provider_account"), "valid_from")
    first = first.groupBy("psp", "provider_account").agg(F.min("valid_from").alias("first_day"))
    narrow = sales.select("psp", "provider_account", PROVIDER_ID, F.to_date("event_timestamp_utc").alias("day"))
    covered = salted_join(narrow, first, ["psp", "provider_account"], "inner").filter("day >= first_day")
    return differing_keys(covered, detail, ["psp", PROVIDER_ID])


def fee_summary_differences(detail: DataFrame, summary: DataFrame) -> DataFrame:
    """Summary groups that re-aggregated detail does not confirm; a NULL group key counts."""
    keys = ["report_month", "psp", "provider_account", "fee_currency", "cause"]
    sums = ["reported_fee_local", "expected_fee_local", "signed_fee_variance_usd"]
    again = detail.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"), *(F.sum(c).alias(c) for c in sums))
    return differing_keys(again, summary, keys, ["event_count", *sums])


def summary_differences(detail: DataFrame, summary: DataFrame) -> DataFrame:
    """Summary rows that differ, as a multiset, from the re-aggregated detail."""
    again = cause_totals(detail)
    return multiset_differences(again, summary.select(*again.columns))


def source_total_gaps(engine: DataFrame, provider: DataFrame, detail: DataFrame, months: Sequence[date]) -> DataFrame:
    """Providers and sides whose totals in the ledgers and in the detail disagree.

    An absent ledger group counts as zero; a NULL total of an existing group does not.
    """

    def ledger(df: DataFrame, side: str, clock: str, amount: Column) -> DataFrame:
        month_list = F.array(*(F.lit(m).cast("date") for m in months))
        dated = df.withColumn("report_month", F.trunc(clock, "MM"))
        kept = dated.filter(F.array_contains(month_list, F.col("report_month")))
        return kept.groupBy("report_month", "psp").agg(
            F.lit(side).alias("side"),
            F.lit(True).alias("in_ledger"),
            F.count(F.lit(1)).alias("records"),
            F.sum(F.col("is_financial_event").cast("int")).alias("financial_events"),
            F.sum(F.when(F.col("is_financial_event"), amount).otherwise(F.lit(0))).cast(_TOTAL).alias("amount_usd"),
        )

    sources = ledger(engine, "engine", "scope_timestamp_utc", F.col("amount_usd_signed")).unionByName(
        ledger(provider, "provider", "event_timestamp_utc", cents("amount_usd_normalized"))
    )
    sums = [
        (f"{side}_{name}", expr.format(side=side))
        for side in ("engine", "provider")
        for name, expr in (
            ("records", "sum(cast({side}_in_period as int))"),
            ("financial", "sum(cast(({side}_in_period and {side}_is_financial_event) as int))"),
            ("usd", "sum({side}_recognized_usd)"),
        )
    ]
    reported = detail.groupBy("report_month", "psp").agg(*(F.expr(e).alias(n) for n, e in sums))
    reported = reported.selectExpr(
        "report_month",
        "psp",
        "stack(2, 'engine', engine_records, engine_financial, cast(engine_usd as decimal(38,8)),"
        " 'provider', provider_records, provider_financial, cast(provider_usd as decimal(38,8)))"
        " AS (side, d_records, d_financial_events, d_amount_usd)",
        "true AS in_detail",
    )
    # A few rows per provider and month are left on either side here.
    compared = sources.join(reported, ["report_month", "psp", "side"], "full")
    gap = F.col("in_detail").isNull()
    for name in ("records", "financial_events", "amount_usd"):
        source = F.when(F.col("in_ledger"), F.col(name)).otherwise(F.lit(0))
        gap = gap | ~source.eqNullSafe(F.col(f"d_{name}"))
    return compared.filter(gap)
