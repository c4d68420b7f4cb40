"""Exact dedup with a persistent index of text digests.

The index is a catalog table bucketed and sorted by digest. New data is reduced to one
row per digest (tasks combine before they send, so a text with a third of all rows costs
a row per task), anti-joined with the index in a sort-merge join that reads the index
bucket by bucket without a shuffle, and what is new is appended. Native DataFrame code.

Results for odd input: a null text counts as empty; rows with equal text and equal id are
told apart by number and only the first is kept; a null id sorts before all others; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from crosstally.llm.common import normalised, partitions, saved


class DigestIndex:
    """Digests seen so far, each with the id that keeps its text: (digest binary, keep_id)."""

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        """`name` is a catalog table; an existing one is taken up again with its `buckets`."""
        self.spark = spark
        self.name = name or f"digests_{uuid.uuid4().hex}"
        self.buckets = buckets or partitions(spark)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> DataFrame:
        """Append what is new among (digest, doc_id); returns the rows appended."""
        firsts = digests.groupBy("digest").agg(F.min_by("doc_id", _order("doc_id")).alias("keep_id"))
        if self.exists():
            seen = self.read().select("digest").hint("merge")
            firsts = firsts.hint("merge").join(seen, "digest", "left_anti")
        fresh = saved(firsts, "fresh_digests")
        dealt = fresh.repartition(self.buckets, "digest")  # a file for each bucket
        writer = dealt.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
        writer.mode("append").saveAsTable(self.name)
        return fresh


def _order(name: str):
    return F.struct(F.col(name).isNotNull(), F.col(name))


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, digest): SHA-256 of the normalised text, as 32 bytes."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)).alias("digest")
    )


def exact_dedup(docs: DataFrame, index: DigestIndex, loads: int = 2) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The documents arrive in `loads` loads, in ranges of doc_id; each load is deduplicated
    against the index of all earlier ones. With a fresh index the smallest doc_id of equal
    texts therefore stays.
    """
    own = saved(digests(docs), "digests")
    low, high = own.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        index.add(own)
    else:
        width = (high - low) // loads + 1
        above = F.col("doc_id").cast("decimal(20,0)") - F.lit(str(low)).cast("decimal(20,0)")
        load_no = F.coalesce(F.call_function("div", above, F.lit(str(width)).cast("decimal(20,0)")), F.lit(0))
        for load in range(loads):
            index.add(own.filter(load_no == load))
    sizes = own.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = saved(sizes.join(index.read(), "digest"), "digest_groups")
    repeats = Window.partitionBy("digest", "doc_id").orderBy(F.lit(1))
    numbered = own.withColumn("_repeat", F.row_number().over(repeats))
    joined = numbered.join(groups.hint("merge"), "digest")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_repeat") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; repeated rows stay once.

    Ids take part as two columns without nulls, so that the join and the removal of repeats
    hash alike and texts are sent once.
    """

    def key(doc_id: Column, digest: Column) -> dict[str, Column]:
        return {"_digest": digest, "_has_id": doc_id.isNotNull(), "_id": F.coalesce(doc_id.cast("string"), F.lit(""))}

    decisions = exact_dedup(docs, index).filter("kept")
    kept = decisions.select(*(c.alias(n) for n, c in key(F.col("doc_id"), F.unhex("text_sha256")).items()))
    own = docs.withColumns(key(F.col("doc_id"), F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))))
    names = ["_digest", "_has_id", "_id"]
    return own.join(saved(kept, "kept_digests"), names, "left_semi").dropDuplicates(names).select(*docs.columns)
