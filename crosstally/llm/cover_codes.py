"""Vector codes by product quantisation: Lloyd's rounds over cover trees.

Vectors become integers and are cut into equal parts; each part has a codebook that Lloyd's
rounds improve. Every task builds cover trees over its own vectors, one for each part of a
block of vectors: a node has a routing point, a radius that covers its points, and a range
of the block's points in tree order. Its points near the routing point form one child with
the same routing point, those farther off are covered by others. Trees are written once
and read again by each round.

A round goes down the trees a level at a time. By the triangle inequality, an entry
farther from the routing point than the nearest one by more than twice the radius is
nearest for no point below. If a single entry is left, the whole subtree is assigned to
it, and its sum and count come from cumulative sums over the tree order. Only ambiguous
nodes are opened, and only points of ambiguous leaves are compared with all entries, in
integers. A round sends one sum for each entry and component of a task.

Blocks are bounded in rows and in bytes; codebooks have `entries` times the vectors' width
numbers, which is all that is broadcast or reaches the driver.

Results for odd input: vectors that are null or hold null or non-finite components take no
part; the width is that of the longest vector, rounded up to whole parts, and shorter
vectors (empty ones included) count as zero beyond their end; rows that repeat an id are
vectors of their own; null ids come last among the first codebook entries, ties there go
by the vector; equal distances go to the lower index; with fewer vectors than entries the
codebook is smaller; null labels are one label; other columns are ignored; an empty table
gives an empty result. Components too large for exact 64-bit distances fail the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crosstally.llm.common import saved, ship_package
from crosstally.operators.skew import salted_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
BLOCK_ROWS = 8192
BLOCK_BYTES = 8 << 20
#: Points a leaf holds at most, unless they are equal.
LEAF = 32
#: A child covers its points within the parent's radius divided by this.
SHRINK = 1.6


@dataclass(frozen=True)
class Tree:
    """Nodes in level order: point range in tree order, routing point, radius, range of children."""

    order: np.ndarray
    nodes: np.ndarray  # rows of start, end, routing point (in tree order), first child, last child + 1
    radius: np.ndarray

    def pack(self) -> bytes:
        head = np.array([len(self.order), len(self.nodes)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.order.astype(np.int64), self.nodes, self.radius))

    @staticmethod
    def unpack(data: bytes) -> Tree:
        n, m = np.frombuffer(data, np.int64, 2)
        order = np.frombuffer(data, np.int64, n, 16)
        nodes = np.frombuffer(data, np.int64, 5 * m, 16 + 8 * n).reshape(m, 5)
        return Tree(order, nodes, np.frombuffer(data, np.float64, m, 16 + 8 * n + 40 * m))


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (points x entries) of integers.

    Floating point multiplies faster and is exact while all sums stay below 2**53.
    """
    bound = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * bound * bound * max(1, points.shape[1]) >= 1 << 62:
        raise ValueError(f"components of magnitude {bound} are too large for exact 64-bit distances")
    if 4 * bound * bound * max(1, points.shape[1]) < 1 << 53:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
    squares = (points * points).sum(1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(1)[None, :]
    return squares.astype(np.int64)


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Cover tree of integer points (n x width); its ranges nest, and children lie side by side."""
    order = np.arange(len(points))
    far = points.astype(np.float64)
    nodes, radius = [], []

    def node(start: int, end: int, distance: np.ndarray) -> int:
        """Add a node whose routing point stands first in its range."""
        nodes.append([start, end, start, 0, 0])
        radius.append(float(distance.max(initial=0.0)))
        return len(nodes) - 1

    def gaps(start: int, end: int) -> np.ndarray:
        return np.sqrt(((far[order[start:end]] - far[order[start]]) ** 2).sum(1))

    if len(points):
        first = gaps(0, len(points))
        level = [(node(0, len(points), first), first)]
    else:
        level = []
    while level:
        following = []
        for number, distance in level:
            start, end = nodes[number][:2]
            if end - start <= leaf or radius[number] == 0.0:
                continue
            near = radius[number] / SHRINK
            nodes[number][3] = len(nodes)
            while start < end:
                inside = distance <= near
                picked = order[start:end]
                order[start:end] = np.concatenate([picked[inside], picked[~inside]])
                cut = start + int(inside.sum())
                following.append((node(start, cut, distance[inside]), distance[inside]))
                start = cut
                if start < end:
                    distance = gaps(start, end)
            nodes[number][4] = len(nodes)
        level = following
    return Tree(order, np.array(nodes, np.int64).reshape(-1, 5), np.array(radius))


@dataclass
class Assigned:
    """Labels in tree order, sums and counts by entry, and how many points were compared one by one."""

    labels: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    compared: int


def assign(tree: Tree, points: np.ndarray, entries: np.ndarray) -> Assigned:
    """Nearest entry of each point; `points` are in tree order."""
    n, k = len(points), len(entries)
    cumulative = np.concatenate([np.zeros((1, points.shape[1]), np.int64), points.cumsum(0)])
    labels = np.zeros(n, np.int64)
    sums, counts = np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64)
    open_nodes = np.zeros(1 if n else 0, np.int64)
    steps = np.zeros(n + 1, np.int64)
    compared = [np.zeros(0, np.int64)]
    while len(open_nodes):
        start, end, routing, child, last = tree.nodes[open_nodes].T
        root = np.sqrt(_distances(points[routing], entries).astype(np.float64))
        nearest = root.argmin(1)
        least = root[np.arange(len(root)), nearest]
        # A little wider than the inequality asks, against rounding of square roots.
        reach = (least + 2 * tree.radius[open_nodes]) * (1 + 1e-9) + 1e-9
        sure = (root <= reach[:, None]).sum(1) == 1
        won = nearest[sure]
        np.add.at(sums, won, cumulative[end[sure]] - cumulative[start[sure]])
        np.add.at(counts, won, end[sure] - start[sure])
        np.add.at(steps, start[sure], won)
        np.add.at(steps, end[sure], -won)
        leaf = ~sure & (last == 0)
        compared.append(_ranges(start[leaf], end[leaf]))
        inner = ~sure & (last > 0)
        open_nodes = _ranges(child[inner], last[inner])
    labels = steps.cumsum()[:n]
    rest = np.concatenate(compared)
    for at in range(0, len(rest), BLOCK_ROWS):
        some = rest[at : at + BLOCK_ROWS]
        best = _distances(points[some], entries).argmin(1)
        labels[some] = best
        np.add.at(sums, best, points[some])
        np.add.at(counts, best, 1)
    return Assigned(labels, sums, counts, len(rest))


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    sizes = last - first
    shift = np.repeat(first - np.concatenate(([0], sizes.cumsum()[:-1]))[: len(sizes)], sizes)
    return shift + np.arange(int(sizes.sum()))


# -- vectors and blocks ----------------------------------------------------------------


def quantised(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, terms array<long>): components as floor(scale * x); usable vectors only."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter(x.isNotNull() & fine).select(
        F.col(vec_id).alias("vec_id"),
        F.col(label).alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms"),
    )


def _dense(terms: pa.ListArray, width: int) -> np.ndarray:
    flat = np.asarray(terms.flatten(), np.int64)
    sizes = np.diff(np.asarray(terms.offsets, np.int64))
    if (sizes == width).all():
        return flat.reshape(len(terms), width)
    out = np.zeros((len(terms), width), np.int64)
    out[np.repeat(np.arange(len(terms)), sizes), _ranges(np.zeros(len(sizes), np.int64), sizes)] = flat
    return out


def _list_of(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def blocks_of(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """Blocks of vectors with a packed cover tree for each part: ids, labels, kind, terms, trees."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    block_rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width))))
    step = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), block_rows):
                some = batch.slice(at, block_rows)
                dense = _dense(some.column("terms"), width)
                trees = [build_tree(dense[:, p * step : (p + 1) * step]).pack() for p in range(parts)]
                kind = np.result_type(np.min_scalar_type(min(0, dense.min(initial=0))),
                                      np.min_scalar_type(-int(dense.max(initial=0)) - 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        _list_of(some.column("vec_id")),
                        _list_of(some.column("label")),
                        pa.array([kind.str]),
                        pa.array([dense.astype(kind).tobytes()], pa.binary()),
                        _list_of(pa.array(trees, pa.binary())),
                    ],
                    names=["ids", "labels", "kind", "terms", "trees"],
                )

    return rows.mapInArrow(
        run, f"ids array<{types['vec_id']}>, labels array<{types['label']}>, kind string, terms binary, trees array<binary>"
    )


def _opened(batch: pa.RecordBatch, i: int, width: int, parts: int) -> Iterator[tuple[int, Tree, np.ndarray]]:
    """(part, tree, points in tree order) of a block."""
    dense = np.frombuffer(batch.column("terms")[i].as_py(), np.dtype(batch.column("kind")[i].as_py()))
    dense = dense.reshape(-1, parts, width // parts)
    for part, data in enumerate(batch.column("trees")[i].as_py()):
        tree = Tree.unpack(data)
        yield part, tree, dense[tree.order, part].astype(np.int64)


def _round(blocks: DataFrame, codebooks: np.ndarray, width: int) -> np.ndarray:
    """The codebooks after one round: each entry the floor of its points' mean, unused ones as they were."""
    parts, entries, step = codebooks.shape
    shared = blocks.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for i in range(len(batch)):
                for part, tree, points in _opened(batch, i, width, parts):
                    found = assign(tree, points, books[part])
                    sums[part] += found.sums
                    counts[part] += found.counts
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts.ravel()[used]),
             pa.array(list(sums.reshape(parts * entries, step)[used]), pa.list_(pa.int64()))],
            names=["slot", "n", "sums"],
        )

    found = blocks.select("kind", "terms", "trees").mapInArrow(run, "slot long, n long, sums array<long>")
    spread = found.select("slot", "n", F.posexplode("sums").alias("at", "x"))
    total = spread.groupBy("slot", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    after = codebooks.copy()
    for row in total.collect():  # a row for each number of the codebooks
        after[row["slot"] // entries, row["slot"] % entries, row["at"]] = row["x"] // row["n"]
    return after


def _coded(blocks: DataFrame, codebooks: np.ndarray, width: int) -> DataFrame:
    """(vec_id, label, code array<int>, error) of every vector."""
    parts = len(codebooks)
    shared = blocks.sparkSession.sparkContext.broadcast(codebooks)
    types = {f.name: f.dataType.elementType.simpleString() for f in blocks.schema if f.name in ("ids", "labels")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            for i in range(len(batch)):
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                codes, error = np.zeros((len(ids), parts), np.int32), np.zeros(len(ids), np.int64)
                for part, tree, points in _opened(batch, i, width, parts):
                    chosen = assign(tree, points, books[part]).labels
                    codes[tree.order, part] = chosen
                    error[tree.order] += ((points - books[part][chosen]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(list(codes), pa.list_(pa.int32())), pa.array(error)],
                    names=["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(run, f"vec_id {types['ids']}, label {types['labels']}, code array<int>, error long")


@dataclass(frozen=True)
class Compressed:
    """codes (vec_id, label, code array<int>, error) and codebooks (parts x entries x width)."""

    codes: DataFrame
    codebooks: np.ndarray

    def codebooks_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    *,
    scale: int = 256,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Compressed:
    """Learn codebooks from the vectors of the smallest ids on and code every vector."""
    ship_package(vectors.sparkSession)
    rows = quantised(vectors, vec_id, vector, label, scale)
    longest = rows.agg(F.max(F.size("terms"))).first()[0] or 0
    width = -(-longest // parts) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "terms").limit(entries).select("terms").collect()
    start = np.zeros((len(first), width), np.int64)
    for i, row in enumerate(first):
        start[i, : len(row["terms"])] = row["terms"]
    codebooks = np.ascontiguousarray(start.reshape(len(first), parts, width // parts).transpose(1, 0, 2))
    blocks = saved(blocks_of(rows, width, parts), "cover_trees")
    for _ in range(rounds):
        codebooks = _round(blocks, codebooks, width)
    return Compressed(saved(_coded(blocks, codebooks, width), "vector_codes"), codebooks)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """`codes` with label_error, the sum of errors over equal labels; null labels are one."""
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    named = codes.withColumn("_label", label)
    totals = named.groupBy("_label").agg(F.sum("error").alias("label_error"))
    return salted_join(named, totals, ["_label"], "inner").drop("_label")


def hex_code(code: str):
    """Two lowercase hex digits for each index of a code."""
    return F.lower(F.array_join(F.transform(code, lambda c: F.lpad(F.hex(c), 2, "0")), ""))
