"""URL filtering by listed rules and by mined association rules.

Listed rules name a host and the start of a path; the longest that fits decides. All
other URLs are judged by association rules: Spark's FP-growth mines combinations of URL
tokens that go with the label `block` in labelled URLs: parts of host, path and query with
their places, and every host label, path segment, query key and key with value. Rules below
the support or the confidence are pruned, and so is every rule that contains another one, as
it adds no verdict; all others are kept. An inverted index holds each rule under its rarest
token; a URL looks its tokens up there and is blocked if all tokens of a rule found are its
own. Without such a rule it is allowed.

Two reductions keep mining small and lose no rule. Tokens that too few blocked URLs hold to
be in any rule are dropped, which leaves at most 1 / MIN_SUPPORT times the tokens of a URL.
Tokens of the same labelled URLs form a class: one stands for all in mining and in rules,
and a URL holds the class if it holds any token of it. How many rules there are depends on
how many independent frequent tokens a URL holds.

Results for odd input: a null URL or one without `://` has an empty host, an empty path,
no tokens and the verdict allow; without labelled or without blocked URLs nothing is
mined; repeated rows are judged alike, row by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from crosstally.llm.common import saved

ALLOW, BLOCK = "allow", "block"
LABEL = "label=block"
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest listed rule that fits, else nulls; a tie goes to the earlier rule."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """At most nine distinct tokens: parts of host, path and query, each with its place."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)\?([^=&#]+)", 1)

    def named(place: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(place + "="), value))

    found = F.array(
        named("tld", F.substring_index(host, ".", -1)),
        named("domain", F.substring_index(host, ".", -2)),
        named("site", F.substring_index(host, ".", -3)),
        named("host", host),
        named("sub", F.regexp_extract(host, r"^([^.]+)\.[^.]+\.[^.]+", 1)),
        named("dir", F.regexp_extract(path, r"^/([^/]+)", 1)),
        named("dirs", F.regexp_extract(path, r"^(/[^/]+/[^/]+)/", 1)),
        named("ending", F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)),
        named("query", query),
    )
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: t.isNotNull())))


def all_tokens(url: Column) -> Column:
    """The tokens of `tokens_of`, and every host label, path segment, query key and key with value."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)

    def named(place: str, values: Column) -> Column:
        found = F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(place + "="), v))
        return F.coalesce(found, F.array().cast("array<string>"))

    pairs = F.split(query, "&")
    more = F.concat(
        named("label", F.split(host_of(url), r"\.")),
        named("segment", F.split(path_of(url), "/")),
        named("key", F.transform(pairs, lambda v: F.substring_index(v, "=", 1))),
        named("pair", F.filter(pairs, lambda v: v.contains("="))),
    )
    return F.array_sort(F.array_distinct(F.concat(tokens_of(url), more)))


_MINED = "tokens array<string>, confidence double, support double, classes array<struct<token: string, alike: array<string>>>"


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, confidence, support, classes) for blocking, from (url, verdict) rows.

    `tokens` are those that stand for their classes; `classes` lists all tokens of each.
    """
    blocks = F.col("verdict").eqNullSafe(BLOCK)
    rows = labelled.select(all_tokens(F.col("url")).alias("all"), blocks.alias("blocks"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "url_rows")
    n_rows, n_blocked = rows.agg(F.count("*"), F.count_if("blocks")).first()
    if not n_blocked:
        return labelled.sparkSession.createDataFrame([], _MINED)
    each = rows.select("row", "blocks", F.explode("all").alias("token"))
    held = each.groupBy("token").agg(
        F.count_if("blocks").alias("blocked"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("row")).alias("one"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("two"),
    )
    held = held.filter(F.col("blocked") >= min_support * n_rows)
    alike = held.groupBy("blocked", "n", "one", "two").agg(F.min("token").alias("rep"), F.sort_array(F.collect_list("token")).alias("alike"))
    alike = saved(alike.select("rep", "alike"), "url_alike")
    stands = alike.select("rep", F.explode("alike").alias("token")).filter("rep = token")
    reps = each.join(stands, "token").groupBy("row").agg(F.collect_set("token").alias("items"))
    label = F.when(F.col("blocks"), F.array(F.lit(LABEL))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    baskets = rows.select("row", "blocks").join(reps, "row", "left").select(F.concat(F.coalesce("items", none), label).alias("items"))
    rules = saved(minimal(_rules(saved(baskets, "url_baskets"), min_support, min_confidence)), "url_rules")
    named = rules.select("tokens", F.explode("tokens").alias("rep")).join(alike, "rep")
    named = named.groupBy("tokens").agg(F.sort_array(F.collect_list(F.struct(F.col("rep").alias("token"), "alike"))).alias("classes"))
    return saved(rules.join(named, "tokens").select("tokens", "confidence", "support", "classes"), "url_rules")


def _rules(baskets: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.filter(F.col("consequent") == F.array(F.lit(LABEL)))
    return saved(found.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "url_rules")


def fitting(kinds: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, rule_tokens): the rules that a row of `kinds` fulfils, by the inverted index."""
    index = inverted_index(rules).select(F.col("token").alias("rep"), F.col("tokens").alias("rule_tokens"))
    classes = rules.select(F.explode("classes").alias("c")).distinct()
    members = classes.select(F.col("c.token").alias("rep"), F.explode("c.alike").alias("token"))
    own = kinds.select("tokens", F.explode("tokens").alias("token")).join(members, "token")
    own = own.groupBy("tokens").agg(F.collect_set("rep").alias("reps"))
    looked_up = own.select("tokens", "reps", F.explode("reps").alias("rep")).join(index, "rep")
    return looked_up.filter(F.size(F.array_except("rule_tokens", "reps")) == 0).select("tokens", "rule_tokens")


def minimal(rules: DataFrame) -> DataFrame:
    """Rules that contain no other rule."""
    smaller = inverted_index(rules).select("token", F.col("tokens").alias("inner_tokens"))
    looked_up = rules.select("tokens", F.explode("tokens").alias("token"))
    contained = looked_up.join(smaller, "token").filter(
        (F.size("inner_tokens") < F.size("tokens")) & (F.size(F.array_except("inner_tokens", "tokens")) == 0)
    )
    return rules.join(contained.select("tokens").distinct(), "tokens", "left_anti")


def inverted_index(rules: DataFrame) -> DataFrame:
    """Each rule under its rarest token: the one that the fewest rules hold."""
    held = rules.select("tokens", F.explode("tokens").alias("token"))
    common = held.groupBy("token").agg(F.count("*").alias("n"))
    return held.join(common, "token").groupBy("tokens").agg(F.min_by("token", F.struct("n", "token")).alias("token"))


def judge(pages: DataFrame, rules: Sequence[Rule], mined: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule of every page."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    name, verdict = listed_rule(host, path, rules)
    own = pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), name.alias("rule"),
        verdict.alias("listed"), F.when(name.isNull(), all_tokens(F.col(url))).alias("tokens"),
    )
    own = saved(own, "url_parts")
    # Pages with the same tokens are looked up once.
    kinds = own.filter("tokens IS NOT NULL").select("tokens").distinct()
    found = fitting(kinds, saved(mined, "url_minimal"))
    found = found.groupBy("tokens").agg(F.min(F.array_join("rule_tokens", " ")).alias("mined_rule"))
    judged = own.join(saved(found, "url_fitting"), "tokens", "left")
    method = F.when(F.col("mined_rule").isNotNull(), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("listed", method).alias("verdict"), "mined_rule"
    )


def label_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(url, verdict) of pages that a listed rule decides, or else that a label of the same id names.

    A label blocks if it is toxic or of low quality.
    """
    _, verdict = listed_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    bad = F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int"))
    known = labels.groupBy(F.col("doc_id").alias("_id")).agg(bad.alias("_bad"))
    named = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"))
    named = named.join(known, F.col("page_id") == F.col("_id"), "left").withColumn("_listed", verdict)
    by_label = F.when(F.col("_bad") == 1, F.lit(BLOCK)).when(F.col("_bad") == 0, F.lit(ALLOW))
    return named.select("url", F.coalesce("_listed", by_label).alias("verdict")).filter("verdict IS NOT NULL")
