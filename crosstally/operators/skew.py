"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SALTS = 16

def salted_join(many: DataFrame, unique: DataFrame, keys: Sequence[str], how: str, salts: int = SALTS) -> DataFrame:
    """Inner or left join with a side that holds one row per key.

    Rows of a hot key spread over `salts` tasks by a hash of their content and of the
    partition they come from, so that equal rows of different partitions part too. A
    re-run task computes the same salts. The unique side is repeated once per salt.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join does not support {how!r}")
    content = [F.col(c) for c in many.columns]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.lit(salts)).cast("int")
    salted_many = many.withColumn("_salt", spread)
    salted_unique = unique.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_many.join(salted_unique, [*keys, "_salt"], how).drop("_salt")
