"""Mix sources to target weights by exact block quotas.

Each source is put in a permuted order (by a hash of the id) and cut into BLOCKS equal
stretches of words. A source's target becomes an exact quota of block draws; a source
that must be repeated is drawn in passes over its permuted blocks, so no document is
taken more often than the cap allows. A splitting tree deals the quotas out: at each node
a multivariate hypergeometric draw decides how many blocks of each source go to the left
half of the output shards. A leaf thus holds exact quotas, which it fills with the next
undrawn blocks of each source; rows are shuffled within their shard.

Only one row for each source and one number for each source and shard pass the driver;
sources are the rows of a mixture table, and more than MAX_SOURCES of them are refused.
Positions in the permuted order come from running sums within hash buckets, so a source
with a third of all rows is summed by many tasks.

Results for odd input: a null text has size 0; a null source is a source of its own and
sorts last; documents of size 0 and sources without words are never taken; rows of equal or
null id are drawn each, ordered by size and then by a digest of their text, however long;
an empty table gives an empty result; other columns are kept by `mixed_rows` and ignored by
`draws`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from crosstally.llm.common import saved, word_count

MAX_SOURCES = 100_000
BLOCKS = 1024
SHARDS = 16
#: Hex digits of the hash that name a bucket of the permuted order.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Quota:
    source: str | None
    size: int
    target: Fraction
    blocks: int


def cycling_weights(sources: Sequence[str | None], cycle: Sequence[int] = (1, 2, 3)) -> list[int]:
    return [cycle[i % len(cycle)] for i in range(len(sources))]


def capped_targets(sizes: Sequence[int], weights: Sequence[int], cap: int) -> list[Fraction]:
    """Share the sum of all sizes by weight; no target exceeds `cap` times its size.

    What a capped source can't take is shared again among the others. In the order of
    size / weight the capped sources come first, so one walk finds them.
    """
    targets = [Fraction(0)] * len(sizes)
    left, weight_left = sum(sizes), sum(weights)
    order = sorted(range(len(sizes)), key=lambda i: Fraction(sizes[i], weights[i]))
    for i in order:
        share = Fraction(left * weights[i], weight_left)
        targets[i] = min(share, Fraction(cap * sizes[i]))
        if share > targets[i]:
            left -= cap * sizes[i]
            weight_left -= weights[i]
    return targets


def splitting_tree(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard (shards x sources); columns sum to the quotas."""
    out = np.zeros((shards, len(quotas)), np.int64)
    pending = [(0, shards, np.array(quotas, np.int64))]
    while pending:
        first, last, held = pending.pop()
        if last - first == 1:
            out[first] = held
            continue
        middle = (first + last) // 2
        draws = int(held.sum()) * (middle - first) // (last - first)
        node = np.random.Generator(np.random.PCG64([seed, first, last]))
        left = node.multivariate_hypergeometric(held, draws, method="marginals")
        pending += [(first, middle, left), (middle, last, held - left)]
    return out


def _key(doc_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def row_key() -> Column:
    """A digest of id, source and text: rows of equal key are interchangeable."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("doc_id", "source", "text")]
    return F.unhex(F.md5(F.concat_ws("\0", *marked).cast("binary")))


def draws(
    docs: DataFrame,
    weights: Callable[[Sequence[str | None]], Sequence[int]] = cycling_weights,
    cap: int = 3,
    shards: int = SHARDS,
    seed: int = 0,
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, order_key, row_key, shards.

    `shards` lists the shard of each time the document is drawn; its length times the
    size are the words taken. `weights` maps the sources in code-point order to weights.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        _key("doc_id", seed).alias("order_key"),
        row_key().alias("row_key"),
    )
    narrow = saved(narrow.withColumn("bucket", F.substring("order_key", 1, BUCKET_DIGITS)), "mix_sizes")
    sums = saved(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix_buckets")
    found = sums.groupBy("source").agg(F.sum("words").alias("words")).take(MAX_SOURCES + 1)
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mixture takes at most {MAX_SOURCES} sources")
    found = sorted(((r["source"], r["words"]) for r in found), key=lambda x: (x[0] is None, x[0]))
    names, sizes = [x for x, _ in found], [n for _, n in found]
    targets = capped_targets(sizes, weights(names), cap)
    quotas = [int(t * BLOCKS / n + Fraction(1, 2)) if n else 0 for t, n in zip(targets, sizes)]
    ends = splitting_tree(quotas, shards, seed).cumsum(0).T.tolist()
    plan = spark.createDataFrame(
        [(s, n, float(t), e) for s, n, t, e in zip(names, sizes, targets, ends)],
        "source string, source_size long, target double, ends array<long>",
    )
    # Words before a bucket, then words before a document within its bucket.
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = saved(sums.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))), "mix_offsets")
    running = Window.partitionBy("source", "bucket").orderBy("order_key", "doc_id", "size", "row_key")
    running = running.rowsBetween(Window.unboundedPreceding, -1)
    placed = narrow.withColumn("inside", F.coalesce(F.sum("size").over(running), F.lit(0)))
    o = offsets.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), "offset")
    placed = placed.join(o, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    plan = plan.withColumnRenamed("source", "p_source")
    placed = placed.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source")))
    # The block that holds the middle of the document.
    middle = 2 * (F.col("offset") + F.col("inside")) + F.col("size")
    block = F.expr(f"({BLOCKS}L * _middle) div greatest(2 * source_size, 1)")
    passes = F.sequence(F.lit(0), F.lit(cap - 1))
    drawn = F.transform(passes, lambda p: F.col("_block") + p * BLOCKS)
    drawn = F.filter(drawn, lambda j: (F.col("size") > 0) & (j < F.element_at("ends", -1)))
    shard_of = F.transform(drawn, lambda j: F.size(F.filter("ends", lambda e: e <= j)))
    return (
        placed.withColumn("_middle", middle)
        .withColumn("_block", F.least(block, F.lit(BLOCKS - 1)))
        .select("doc_id", "source", "size", "source_size", "target", "order_key", "row_key", shard_of.alias("shards"))
    )


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken and shards of every document."""
    return draws(docs, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards"
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with all columns of `docs`, once for each draw, shuffled within shards.

    Texts are sent once, by the digest of their row; rows of equal digest take one draw list
    each, so ids may repeat or be null.
    """
    drawn = draws(docs, **options).filter(F.size("shards") > 0)
    picked = saved(drawn.groupBy("row_key").agg(F.collect_list("shards").alias("_lists")), "mix_draws")
    rows = docs.withColumn("_row_key", row_key()).join(picked, F.col("_row_key") == F.col("row_key"))
    nth = F.row_number().over(Window.partitionBy("_row_key").orderBy("_row_key"))
    rows = rows.withColumn("_nth", nth).filter(F.col("_nth") <= F.size("_lists"))
    rows = rows.withColumn("_shard", F.explode(F.element_at("_lists", F.col("_nth"))))
    rows = rows.withColumn("_order", F.xxhash64("_shard", "_row_key", "_nth"))
    return rows.sortWithinPartitions("_shard", "_order").select(*docs.columns)
