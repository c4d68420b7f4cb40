"""Removal and accounting of exact copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """One row per distinct record, all columns compared.

    Equal rows of different source files differ in their lineage column and stay.
    The hash aggregate removes copies before the shuffle, so a large group of copies
    sends one row per task.
    """
    return df.distinct()


def drop_typed_copies(df: DataFrame, *typed: Column) -> DataFrame:
    """The same after typing: 1.10 and 1.1 are copies, conflicting values are not."""
    return df.select(*typed).distinct()


def row_digest(df: DataFrame) -> Column:
    """SHA-256 over all columns, each as text with its length, so that no two rows write alike."""

    def written(name: str) -> Column:
        text = F.col("`" + name.replace("`", "``") + "`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(written, df.columns)).cast("binary"), 256))


def copy_counts(df: DataFrame) -> DataFrame:
    """One row: records and excess copies, counted apart from `drop_exact_copies`.

    Rows are compared by digest: long texts are not sent.
    """
    groups = df.groupBy(row_digest(df).alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("raw_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("excess_copies"),
    )
