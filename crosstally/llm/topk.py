"""Exact top-k search by term-at-a-time accumulation.

A term is a vector component. Candidates are packed into blocks that hold a posting list
for each term: the rows whose weight is not zero, and the weights. Queries are sparse
rows, packed into blocks too. Each pair of a query block and a candidate block is one
record: a dense array of integer scores gets the weighted postings of one term after
the other, partition selection keeps the k best of the block, and a window merges the
blocks. Every candidate is scored against every query.

Query blocks have a bounded size, so the candidates are read once for each QUERY_BLOCK
queries; neither side is broadcast.

Results for odd input: vectors that are null, empty, or hold null or non-finite
components take no part; a shorter vector counts as zero beyond its end; ties go to the
smaller id; rows that repeat an id are scored each, and a query leaves out all rows of
its own id; other columns are ignored. Sums of products must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from crosstally.llm.common import partitions, ship_package

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 1024


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, terms array<long>): components as floor(scale * x); only usable vectors."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & (F.size(x) > 0)
    return vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & fine).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms"),
    )


def _pack(part: pd.DataFrame) -> tuple[int, int, str, bytes]:
    """(rows, width, type, bytes) of a block; weights take the smallest integer type that holds them."""
    width = max(len(t) for t in part["terms"])
    dense = np.zeros((len(part), width), np.int64)
    for i, terms in enumerate(part["terms"]):
        dense[i, : len(terms)] = terms
    small = np.result_type(np.min_scalar_type(min(0, dense.min())), np.min_scalar_type(-max(0, int(dense.max())) - 1))
    return len(part), width, small.str, part["vec_id"].to_numpy(np.int64).tobytes() + dense.astype(small).tobytes()


def _unpack(n: int, width: int, kind: str, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(data[: 8 * n], np.int64)
    return ids, np.frombuffer(data[8 * n :], np.dtype(kind)).reshape(n, width).astype(np.int64)


def _candidate_blocks(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), CANDIDATE_BLOCK):
                part = batch.iloc[start : start + CANDIDATE_BLOCK]
                yield pd.DataFrame([_pack(part)], columns=["n", "width", "kind", "data"])

    return rows.mapInPandas(run, "n int, width int, kind string, data binary")


def _query_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """Queries dealt to numbered groups of about QUERY_BLOCK by hash, a block for each."""
    groups = max(1, -(-rows.count() // QUERY_BLOCK))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *_pack(part))], columns=["group", "q_n", "q_width", "q_kind", "q_data"])

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(
        run, "group long, q_n int, q_width int, q_kind string, q_data binary"
    ), groups


def score_block(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense scores (queries x candidates), one term after the other."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        asking = np.flatnonzero(queries[:, term])
        posting = np.flatnonzero(candidates[:, term])
        if len(asking) and len(posting):
            added = np.multiply.outer(queries[asking, term], candidates[posting, term])
            if len(posting) == len(candidates) and len(asking) == len(queries):
                scores += added
            else:
                scores[np.ix_(asking, posting)] += added
    return scores


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k best candidates, best first; ties go to the smaller id."""
    usable = np.flatnonzero(ids != own)
    values = scores[usable]
    if len(usable) > k:
        bound = np.partition(values, len(values) - k)[len(values) - k]
        usable = usable[values >= bound]
    return usable[np.lexsort((ids[usable], -scores[usable]))][:k]


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query: query_id, rank (from 1), vec_id, score.

    Both frames hold (vec_id, terms), as `quantised` makes them.
    """
    spark = candidates.sparkSession
    ship_package(spark)
    slices = partitions(spark)
    asking, groups = _query_blocks(queries)
    # The grid of block pairs: each candidate block goes to one slice of every group.
    blocks = _candidate_blocks(candidates).withColumn("slice", F.pmod(F.xxhash64("data"), F.lit(slices)))
    blocks = blocks.withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    asking = asking.withColumn("slice", F.explode(F.expr(f"sequence(0L, {slices - 1}L)")))
    pairs = blocks.join(asking, ["group", "slice"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, weights = _unpack(row.n, row.width, row.kind, row.data)
                query_ids, query_weights = _unpack(row.q_n, row.q_width, row.q_kind, row.q_data)
                found = []
                for query, line in zip(query_ids, score_block(query_weights, weights)):
                    best = best_of(line, ids, query, k)
                    found.append((np.full(len(best), query), ids[best], line[best]))
                columns = [np.concatenate(x) for x in zip(*found)]
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    scored = pairs.mapInPandas(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
