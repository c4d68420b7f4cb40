"""Cardinality-safe matching of engine events with provider events.

Amounts are never keys, so that monetary differences stay visible, and a NULL key
matches nothing. All rules work from one key profile: each row is tagged once for every
rule that takes it, both sides are unioned and counted per rule and key in one shuffle.
Tasks count before they send, so a key that holds a large share of the rows sends one row
per task, and no rule ever pairs every engine row with every provider row of a key. Keys
with one row on either side are settled by the profile alone; rows of other keys that both
sides hold are looked up in one join. A hash leads each key, as sorts compare the first eight
bytes at once and rule and psp hardly differ. Nothing runs until the result is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from crosstally.operators.contracts import MATCH, conform
from crosstally.operators.skew import salted_join

ENGINE_ID = "engine_txn_id"
PROVIDER_ID = "provider_event_id"
MATCHED, UNCLEAR = "match", "unclear"


@dataclass(frozen=True)
class MatchRule:
    """Equality on `keys` for rows that pass the filters.

    one_to_one=True accepts a key only if it has one row on either side, and a pair only
    if neither ID is in another one. False accepts every pair of a key that has a single
    row on one side at least; the key check then reports the repeated IDs. The rows of
    keys repeated on both sides are named by `ambiguous_rows`, counted by `repeated_keys`.
    """

    method: str
    keys: Sequence[str]
    psps: Sequence[str] = ()
    provider_operations: Sequence[str] = ()
    one_to_one: bool = False


def match(engine: DataFrame, provider: DataFrame, rule: MatchRule) -> DataFrame:
    """Matches (psp, engine_txn_id, provider_event_id, match_method) of one rule."""
    return match_all(engine, provider, [rule])


def match_all(engine: DataFrame, provider: DataFrame, rules: Sequence[MatchRule]) -> DataFrame:
    """Matches (psp, engine_txn_id, provider_event_id, match_method) of all rules."""
    return matches_of(link(engine, provider, rules, unclear=False))


def link(engine: DataFrame, provider: DataFrame, rules: Sequence[MatchRule], unclear: bool = True) -> DataFrame:
    """What the rules say about both ledgers: matches, and rows whose key repeats on both sides.

    Rows are (outcome, psp, engine_txn_id, provider_event_id, match_method). A `match` has
    both IDs. An `unclear` row has one and matches nothing, but is not missing on the other
    side either; rules that demand one-to-one candidates have none, as ambiguity is an
    outcome there. `matches_of` and `unclear_of` take it apart; write it once for both.
    """
    rows = _tagged(engine, provider, rules)
    profile = _profile(rows)
    strict = [n for n, rule in enumerate(rules) if rule.one_to_one]
    loose = [n for n, rule in enumerate(rules) if not rule.one_to_one]
    pairs = profile.filter("engine_rows = 1 AND provider_rows = 1").select("_rule", "psp", ENGINE_ID, PROVIDER_ID)
    parts = []
    if strict:
        parts.append(_each_id_once(pairs.filter(F.col("_rule").isin(*strict))).withColumn("outcome", F.lit(MATCHED)))
    if loose:
        parts.append(pairs.filter(F.col("_rule").isin(*loose)).withColumn("outcome", F.lit(MATCHED)))
        uneven = profile.filter("least(engine_rows, provider_rows) >= 1 AND engine_rows + provider_rows > 2")
        uneven = uneven.filter(F.col("_rule").isin(*loose))
        parts.append(_of_uneven_keys(rows, uneven if unclear else uneven.filter("least(engine_rows, provider_rows) = 1")))
    found = reduce(DataFrame.unionByName, parts)
    method = F.element_at(F.array(*(F.lit(rule.method) for rule in rules)), F.col("_rule") + 1)
    return found.select("outcome", "psp", ENGINE_ID, PROVIDER_ID, method.alias("match_method"))


def matches_of(links: DataFrame) -> DataFrame:
    return conform(links.filter(F.col("outcome") == MATCHED), MATCH)


def unclear_of(links: DataFrame) -> DataFrame:
    """(psp, side, id) of the rows whose key repeats on both sides: side E or P, each row once."""
    is_engine = F.col(ENGINE_ID).isNotNull()
    named = links.filter(F.col("outcome") == UNCLEAR).select(
        "psp", F.when(is_engine, "E").otherwise("P").alias("side"), F.coalesce(ENGINE_ID, PROVIDER_ID).alias("id")
    )
    return named.distinct()


def ambiguous_rows(engine: DataFrame, provider: DataFrame, rules: Sequence[MatchRule]) -> DataFrame:
    """(psp, side, id) of the rows whose key repeats on both sides: side E or P, each row once.

    They match nothing, but they are not missing on the other side either. Rules that
    demand one-to-one candidates do not count: ambiguity is an outcome there.
    """
    return unclear_of(link(engine, provider, rules))


def repeated_keys(engine: DataFrame, provider: DataFrame, rules: Sequence[MatchRule]) -> DataFrame:
    """Keys with several rows on both sides, with the number of pairs a join would make.

    Rules that demand one-to-one candidates do not count: ambiguity is an outcome there.
    """
    loose = [rule for rule in rules if not rule.one_to_one]
    if not loose:
        raise ValueError("no rule accepts repeated keys")
    method = F.element_at(F.array(*(F.lit(rule.method) for rule in loose)), F.col("_rule") + 1)
    profile = _profile(_tagged(engine, provider, loose))
    # The key as its rule lists it: psp and the slots in their places.
    slots = [iter(f"_k{i}" for i in range(len(rule.keys) - 1)) for rule in loose]
    written = [F.concat_ws("|", *(k if k == "psp" else next(own) for k in rule.keys)) for rule, own in zip(loose, slots)]
    return profile.filter("engine_rows > 1 AND provider_rows > 1").select(
        "psp",
        method.alias("match_method"),
        F.element_at(F.array(*written), F.col("_rule") + 1).alias("key"),
        "engine_rows",
        "provider_rows",
        (F.col("engine_rows") * F.col("provider_rows")).alias("pairs"),
    )


def _tagged(engine: DataFrame, provider: DataFrame, rules: Sequence[MatchRule]) -> DataFrame:
    """Both ledgers as (psp, _side, _id, _rule, _k0..., _hash): a row for each rule that takes it and whose keys it has."""
    for rule in rules:
        if "psp" not in rule.keys:
            raise ValueError(f"rule {rule.method} lacks the key psp")
        for key in rule.keys:
            if engine.schema[key].dataType != provider.schema[key].dataType:
                raise ValueError(f"key {key} has another type in the provider's ledger")

    width = max(len(rule.keys) for rule in rules) - 1

    def tagged(df: DataFrame, row_id: str, side: str) -> DataFrame:
        taken = []
        for number, rule in enumerate(rules):
            fits = reduce(Column.__and__, (F.col(k).isNotNull() for k in rule.keys))
            if rule.psps:
                fits = fits & F.col("psp").isin(*rule.psps)
            if rule.provider_operations and side == "P":
                fits = fits & F.col("operation_type").isin(*rule.provider_operations)
            # A rule has so many keys; a blank fills the slots that only other rules need.
            keys = [F.col(k).cast("string") for k in rule.keys if k != "psp"]
            keys += [F.lit("")] * (width - len(keys))
            tag = {"_rule": F.lit(number), **{f"_k{i}": key for i, key in enumerate(keys)}}
            taken.append((fits, [value.alias(name) for name, value in tag.items()]))
        own = ["psp", F.lit(side).alias("_side"), F.col(row_id).alias("_id")]
        if len(taken) == 1:
            fits, tag = taken[0]
            return df.filter(fits).select(*own, *tag)
        tags = F.array_compact(F.array(*(F.when(fits, F.struct(*tag)) for fits, tag in taken)))
        return df.select(*own, F.explode(tags).alias("_t")).select("psp", "_side", "_id", "_t.*")

    rows = tagged(engine, ENGINE_ID, "E").unionByName(tagged(provider, PROVIDER_ID, "P"))
    return rows.withColumn("_hash", F.xxhash64(*_rule_key(rows)[1:]))


def _rule_key(rows: DataFrame) -> list[str]:
    return ["_hash", "_rule", "psp", *(c for c in rows.columns if c.startswith("_k"))]


def _profile(rows: DataFrame) -> DataFrame:
    """One row per rule and key: row count and smallest ID of each side."""
    is_engine, is_provider = F.col("_side") == "E", F.col("_side") == "P"
    return rows.groupBy(*_rule_key(rows)).agg(
        F.count_if(is_engine).alias("engine_rows"),
        F.count_if(is_provider).alias("provider_rows"),
        F.min(F.when(is_engine, F.col("_id"))).alias(ENGINE_ID),
        F.min(F.when(is_provider, F.col("_id"))).alias(PROVIDER_ID),
    )


def _each_id_once(pairs: DataFrame) -> DataFrame:
    """Pairs whose IDs occur in no other pair of the rule."""
    by_engine = Window.partitionBy(ENGINE_ID, "psp", "_rule")
    by_provider = Window.partitionBy(PROVIDER_ID, "psp", "_rule")
    counted = pairs.withColumn("_engine_uses", F.count("*").over(by_engine))
    counted = counted.withColumn("_provider_uses", F.count("*").over(by_provider))
    return counted.filter("_engine_uses = 1 AND _provider_uses = 1").select(*pairs.columns)


def _of_uneven_keys(rows: DataFrame, uneven: DataFrame) -> DataFrame:
    """Outcomes of keys with several rows on a side: a pair for each of many rows and the single one, else unclear."""
    found = salted_join(rows, uneven, _rule_key(rows), "inner")
    is_engine, clear = F.col("_side") == "E", F.least("engine_rows", "provider_rows") == 1
    many = F.when(F.col("engine_rows") > 1, "E").otherwise("P")
    found = found.filter(~clear | (F.col("_side") == many))
    return found.select(
        "_rule",
        "psp",
        F.when(is_engine, F.col("_id")).when(clear, F.col(ENGINE_ID)).alias(ENGINE_ID),
        F.when(~is_engine, F.col("_id")).when(clear, F.col(PROVIDER_ID)).alias(PROVIDER_ID),
        F.when(clear, MATCHED).otherwise(UNCLEAR).alias("outcome"),
    )
