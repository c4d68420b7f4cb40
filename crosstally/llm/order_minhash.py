"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text is a sequence of words, a shingle a run of SHINGLE words with its occurrence number.
A sketch holds the ORDER shingles of smallest hash in the order of the text, so texts meet
in a table if they share those shingles in that order, which follows edit similarity rather
than set similarity. Two texts are near duplicates if a banded alignment of their words
needs edits for at most 1 - SIMILARITY of the longer one. With J the shared part of the
shingles a table agrees with probability J**ORDER: for edits of 20% of the words, scattered
evenly, J is 0.47, and a pair agrees in AGREE of the tables with probability 0.99. For texts
of fewer than BRIEF words one table is enough. Texts of at most TINY words also meet by what
is left of them after as many words are taken out as they may differ in, which misses no pair.

Equal texts are one class from the start, and only their first document goes on. Tables join
by equality, in three passes; each one verifies its pairs and contracts classes. First, the
texts of a bucket that agree with one of its first texts in CLOSE tables are compared with
it. The order of texts is the same in all buckets, so copies follow the same few texts: a copy
costs few pairs, never more than one a table, and a group of copies is one class from then on.
Second, each text is compared with the one of another class that agrees with it most. Third,
all pairs that agree and are still of different classes are compared, so no link between
classes is left out: the texts of such pairs go to the cells of their buckets, which align
them there and send links only, fewer than they hold classes. Within a bucket, texts outside
its largest class are compared with all others: a bucket of more than CHUNK texts is cut into
cells of at most about CHUNK such texts and CHUNK others, each a task's work, so no bucket is
cut off. Signatures decide what agrees before any text moves, and texts whose word counts
alone ask for too many edits of all others stay behind. A pair is aligned in the cells of the
first SEEN tables it agrees in, not in the first one only: a signature holds 16 bits of each
bucket, which may agree by chance where there is no common cell.
Linked texts form classes by contraction rounds on the edge table; links of a later pass are
between the classes so far. Every round is written to the shared folder; the driver sees
counts only.

Results for odd input: a null text counts as empty; texts without words are near nothing
and equal only to the same text; texts of one word have that word as their only shingle;
rows that repeat an id are judged each by its text, whatever the others hold; a null id is
the smallest one of its class; the smallest id of a class stays, of several texts with that
id the one whose digest comes first, of rows that repeat id and text each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from crosstally.llm.common import mix64, saved, ship_package

#: Words of a shingle that sketches hold, and of a k-mer that alignments start from.
SHINGLE, K = 2, 5
ORDER = 3
TABLES = 64
SIMILARITY = 0.8
#: Tables in which candidates agree, and in which texts are compared first.
AGREE, CLOSE = 2, 12
#: Texts below this many words are candidates if they agree in one table.
BRIEF = 64
#: Texts of at most this many words also meet by what is left without some of their words.
TINY = 14
#: Texts of a bucket that lead in the first pass.
LEADERS = 8
#: Texts of a bucket that one task compares, and words of such texts.
CHUNK = 8192
CELL_WORDS = 1 << 22
#: Tables whose cells compare a pair: the first ones it agrees in.
SEEN = 2
#: Bytes of text hashed at once.
BLOCK = 1 << 20
#: Table entries worked on at once for a long text.
CELLS = 1 << 21
#: Bins of a text's word counts, one for four words.
MIN_BINS, MAX_BINS = 16, 1024
NULL_ID = -(1 << 63)
PRIME = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: Sequence[bytes]) -> list[np.ndarray]:
    """A 64-bit hash of each word of each text; words are runs without white space."""
    if not texts:
        return []
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    begins, ends = edge[::2], edge[1::2]
    if not len(begins):
        return [np.empty(0, np.uint64) for _ in texts]
    size = ends - begins
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    letters = data[inside].astype(np.uint64) | (place.astype(np.uint64) << np.uint64(8))
    hashes = mix64(np.add.reduceat(mix64(letters + PRIME), np.cumsum(size) - size))
    limits = np.cumsum([len(t) + 1 for t in texts])[:-1]
    return np.split(hashes, np.searchsorted(begins, limits))


def kmers(words: np.ndarray, size: int = K) -> np.ndarray:
    """Hashes of the runs of `size` words; a shorter text has one k-mer, an empty one none."""
    k = min(size, len(words))
    if not k:
        return words
    out = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        out = out * PRIME + words[j : len(words) - k + 1 + j]
    return mix64(out)


def remainders(words: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each rest of a tiny text without as many words as it may differ in.

    Texts of at most TINY words that align within their edits share one: what the alignment matches.
    """
    n = len(words)
    most = int((1 - SIMILARITY) * min(TINY, int(n / SIMILARITY + 1e-9)) + 1e-9)
    if n > TINY or not most:
        return np.empty(0, np.uint64)
    out = []
    for left in range(max(1, n - most), n + 1):
        picked = words[np.array(list(combinations(range(n), left)))]
        hashes = np.full(len(picked), TABLES, np.uint64)
        for j in range(left):
            hashes = mix64(hashes * PRIME + picked[:, j])
        out.append(hashes)
    return np.unique(np.concatenate(out))


def labelled(grams: np.ndarray) -> np.ndarray:
    """Each k-mer with its occurrence number mixed in, so that all are distinct."""
    order = np.argsort(grams, kind="stable")
    g = grams[order]
    new = np.concatenate(([True], g[1:] != g[:-1]))
    first = np.flatnonzero(new)
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.concatenate((first, [len(g)]))))
    out = np.empty_like(grams)
    out[order] = mix64(g + rank.astype(np.uint64) * PRIME)
    return out


_RANDOM = np.random.Generator(np.random.PCG64(20240501))
MULTIPLIERS = _RANDOM.integers(0, 1 << 63, TABLES, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.random(TABLES)


def sketches(words: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each table: its ORDER smallest labelled shingles, in text order.

    Lengths are part of a bucket: table t cuts the scale of log length at random places
    three times as wide as similar lengths may differ.
    """
    grams = kmers(words, SHINGLE)
    n = len(grams)
    if not n:
        return np.empty(0, np.uint64)
    marked = labelled(grams)
    width = -3 * np.log(SIMILARITY)
    out = np.floor(np.log(len(words)) / width + SHIFTS).astype(np.uint64) + np.arange(TABLES, dtype=np.uint64) * PRIME
    step = max(1, CELLS // n)
    for t in range(0, TABLES, step):
        if n > ORDER:
            values = marked[None, :] * MULTIPLIERS[t : t + step, None]
            picked = np.sort(np.argpartition(values, ORDER - 1, 1)[:, :ORDER], 1)
        else:
            picked = np.broadcast_to(np.arange(n), (len(MULTIPLIERS[t : t + step]), n))
        for j in range(picked.shape[1]):
            out[t : t + step] = mix64(out[t : t + step] * PRIME + grams[picked[:, j]])
    return out


def longest_chain(positions: np.ndarray) -> np.ndarray:
    """Indices of a longest increasing subsequence."""
    if len(positions) < 2 or (positions[1:] > positions[:-1]).all():
        return np.arange(len(positions))
    tails: list[int] = []
    ends: list[int] = []
    back = np.empty(len(positions), np.int64)
    for i, p in enumerate(positions.tolist()):
        at = bisect_left(tails, p)
        back[i] = ends[at - 1] if at else -1
        tails[at : at + 1] = [p]
        ends[at : at + 1] = [i]
    chain, i = [], ends[-1]
    while i >= 0:
        chain.append(i)
        i = int(back[i])
    return np.array(chain[::-1])


def banded_distance(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance of two sequences if it is at most `band`, else more than `band`.

    Bits of whole numbers hold where a column of the table of distances goes up or down
    (Myers 1999), so a word of `b` costs a few operations, however long `a` is.
    """
    n, m = len(a), len(b)
    if abs(n - m) > band:
        return band + 1
    if not n or not m:
        return max(n, m)
    at: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        at[word] = at.get(word, 0) | 1 << i
    full, top = (1 << n) - 1, n - 1
    up, down, found = full, 0, n
    for left, word in zip(range(m - 1, -1, -1), b.tolist()):
        same = at.get(word, 0)
        level = (((same & up) + up) ^ up) | same | down
        right_up = down | (full & ~(level | up))
        right_down = up & level
        found += (right_up >> top & 1) - (right_down >> top & 1)
        if found - left > band:
            return band + 1
        right_up = right_up << 1 | 1
        up = (right_down << 1 | ~(level | right_up)) & full
        down = right_up & level & full
    return found


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Edit similarity of two word sequences along a chain of shared k-mers, 0 if below SIMILARITY.

    The chain is a longest one inside the band; what lies between its k-mers is aligned
    word by word if the simple bound on its edits does not decide.
    """
    size = min(K, len(a), len(b))
    if not size:
        return 0.0
    one, two = kmers(a, size), kmers(b, size)
    _, i, j = np.intersect1d(labelled(one), labelled(two), assume_unique=True, return_indices=True)
    return along_shared(a, b, size, i, j)


def along_shared(a: np.ndarray, b: np.ndarray, size: int, i: np.ndarray, j: np.ndarray) -> float:
    """The same, if the places of all shared k-mers of `size` words are known."""
    n, m = len(a), len(b)
    longest = max(n, m)
    band = int((1 - SIMILARITY) * longest + 1e-9)
    if abs(n - m) > band:
        return 0.0
    near = np.abs(i - j) <= band
    order = np.argsort(i[near])
    i, j = i[near][order], j[near][order]
    chain = longest_chain(j)
    # The ends of the texts close the chain: empty matches before and after them.
    i = np.concatenate(([-size], i[chain], [n]))
    j = np.concatenate(([-size], j[chain], [m]))
    di, dj = np.diff(i), np.diff(j)
    edits = np.abs(di - dj) + np.maximum(np.minimum(di, dj) - size, 0)
    if edits.sum() > band:
        words_one, count_one = np.unique(a, return_counts=True)
        words_two, count_two = np.unique(b, return_counts=True)
        _, x, y = np.intersect1d(words_one, words_two, assume_unique=True, return_indices=True)
        if longest - np.minimum(count_one[x], count_two[y]).sum() > band:
            return 0.0
        for g in np.flatnonzero(np.minimum(di, dj) > size).tolist():
            inner_one = a[i[g] + size : i[g + 1]]
            inner_two = b[j[g] + size : j[g + 1]]
            edits[g] = banded_distance(inner_one, inner_two, min(band, int(edits[g])))
    found = 1 - int(edits.sum()) / longest
    return found if edits.sum() <= band else 0.0


def _blocks(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    begin = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total > BLOCK:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def word_bins(words: np.ndarray) -> bytes:
    """How many words fall into each bin, by their hashes; counts beyond 255 are cut."""
    bins = 1 << int(np.clip(len(words) // 4, MIN_BINS, MAX_BINS)).bit_length() - 1
    return np.minimum(np.bincount((words & np.uint64(bins - 1)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def least_edits(bins: bytes, others: list[bytes]) -> np.ndarray:
    """A lower bound of the edits between texts, by their bins.

    An edit changes two counts by one at most. Adding up bins, or cutting counts, only lowers
    the differences, so the bound holds for bins of different number too.
    """
    own = np.frombuffer(bins, np.uint8).astype(np.int32)
    found = np.zeros(len(others), np.int64)
    sizes = np.array([len(o) for o in others])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        held = np.frombuffer(b"".join([others[i] for i in at.tolist()]), np.uint8).reshape(len(at), size).astype(np.int32)
        least = min(size, len(own))
        if (held == 255).any() or (own == 255).any():
            if size != len(own):
                continue  # cut counts can't be added up
        gap = np.abs(held.reshape(len(at), -1, least).sum(1) - own.reshape(-1, least).sum(0)).sum(1)
        found[at] = (gap + 1) // 2
    return found


def sketch_texts(docs: DataFrame) -> DataFrame:
    """(id, text_hash, buckets, signature, bins, words) of each row of (id, text_hash, text as binary).

    The signature holds 16 bits of the bucket of each table; `words` is their number.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [bytes(t) for t in batch["text"]]
            found, signatures, bins, sizes = [], [], [], []
            for a, b in _blocks([len(t) for t in texts]):
                for words in word_hashes(texts[a:b]):
                    tables = sketches(words)
                    found.append(np.concatenate((tables, remainders(words))).view(np.int64))
                    signatures.append(tables.astype("<u2").tobytes())
                    bins.append(word_bins(words))
                    sizes.append(len(words))
            out = {"id": batch["id"], "text_hash": batch["text_hash"], "buckets": found, "signature": signatures}
            yield pd.DataFrame(out | {"bins": bins, "words": sizes})

    return docs.mapInPandas(run, "id long, text_hash binary, buckets array<long>, signature binary, bins binary, words int")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of each pair of ids; 0 if the texts are not near."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            one, two = [bytes(t) for t in batch["text_a"]], [bytes(t) for t in batch["text_b"]]
            found = []
            for x, y in _blocks([len(s) + len(t) for s, t in zip(one, two)]):
                words = word_hashes(one[x:y] + two[x:y])
                found += [similarity(s, t) for s, t in zip(words[: y - x], words[y - x :])]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": found})

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInPandas(run, "a long, b long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """(id, class_id): the smallest id that links lead to, for every id in a link (a, b).

    Each round maps every node to its smallest neighbour and contracts the edges.
    """
    edges = saved(links.select("a", "b").distinct(), "edges")
    ends = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    classes = saved(ends.withColumn("class_id", F.col("id")), "classes")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("low"))
        smallest = saved(smallest.select(F.col("a").alias("node"), F.least("a", "low").alias("low")), "contraction")
        classes = saved(
            classes.join(smallest, F.col("class_id") == F.col("node"), "left").select(
                "id", F.coalesce("low", "class_id").alias("class_id")
            ),
            "classes",
        )
        at_a = smallest.select(F.col("node").alias("a"), F.col("low").alias("low_a"))
        at_b = smallest.select(F.col("node").alias("b"), F.col("low").alias("low_b"))
        moved = edges.join(at_a, "a").join(at_b, "b").filter("low_a <> low_b")
        moved = moved.select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
        edges = saved(moved.distinct(), "edges")
    return classes


def more_linked(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes of `components` after more links (a, b): only what lies between classes is contracted."""
    at_a = classes.select(F.col("id").alias("a"), F.col("class_id").alias("class_a"))
    at_b = classes.select(F.col("id").alias("b"), F.col("class_id").alias("class_b"))
    between = links.select("a", "b").join(at_a, "a", "left").join(at_b, "b", "left")
    between = between.select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))
    joined = components(between.filter("a <> b"))
    moved = joined.select(F.col("id").alias("class_id"), F.col("class_id").alias("low"))
    known = classes.join(moved, "class_id", "left").select("id", F.coalesce("low", "class_id").alias("class_id"))
    return saved(known.unionByName(joined.join(classes, "id", "left_anti")), "classes")


def candidate_rows(sketched: DataFrame) -> DataFrame:
    """(bucket, id, n, place, signature, bins, words) of the buckets with several texts.

    `place` is the table of a bucket, TABLES for what is left of tiny texts.
    """
    rows = sketched.select("id", F.posexplode("buckets").alias("place", "bucket"))
    rows = rows.withColumn("place", F.least("place", F.lit(TABLES)).cast("short"))
    live = saved(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "live_buckets")
    shared = saved(rows.join(live, "bucket"), "shared_rows")
    return saved(shared.join(sketched.select("id", "signature", "bins", "words"), "id"), "bucket_rows")


def shared_grams(texts: list[np.ndarray], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The labelled runs of `size` words of all texts, numbered: (numbers, begin and count of each text's)."""
    grams = [labelled(kmers(words, size)) for words in texts]
    counts = np.array([len(g) for g in grams])
    return np.unique(np.concatenate(grams), return_inverse=True)[1], np.cumsum(counts) - counts, counts


class Grams:
    """The labelled runs of `size` words of all texts, and which of them texts share."""

    def __init__(self, texts: list[np.ndarray], size: int):
        self.numbers, self.begin, self.count = shared_grams(texts, size)
        self._place = np.full(len(self.numbers), -1)

    def of(self, text: int) -> np.ndarray:
        return self.numbers[self.begin[text] : self.begin[text] + self.count[text]]

    def shared(self, text: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many runs each of the others shares with the text, and of all these the places in both."""
        own, n = self.of(text), self.count[others]
        first = np.cumsum(n) - n
        within = np.arange(n.sum()) - np.repeat(first, n)
        self._place[own] = np.arange(len(own))
        place = self._place[self.numbers[np.repeat(self.begin[others], n) + within]]
        self._place[own] = -1
        held = place >= 0
        return np.add.reduceat(held.astype(np.int64), first), place[held], within[held]


def agreeing(
    signature: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """In how many tables each of the others agrees, and whether it is a candidate by that and its words."""
    agreed = (others == signature).sum(1)
    longest = np.maximum(sizes, size)
    least = np.where(longest <= TINY, 0, np.where(longest < BRIEF, 1, AGREE))
    return agreed, (agreed >= least) & (np.abs(sizes - size) <= (1 - SIMILARITY) * longest + 1e-9)


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows of equal keys out of sorted batches; a group may reach over several batches."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        values = batch[keys].to_numpy()
        if not len(values):
            continue
        first = np.flatnonzero(np.concatenate(([True], (values[1:] != values[:-1]).any(1))))
        for a, b in zip(first[:-1], first[1:]):
            yield batch.iloc[a:b]
        rest = batch.iloc[first[-1] :]
    if rest is not None:
        yield rest


def _signatures(group: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(group["signature"]), "<u2").reshape(len(group), TABLES)


def close_pairs(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Distinct (a, b), a < b, of texts and a leader of their bucket that agree in CLOSE tables.

    Only saves the later passes work: texts that follow no leader here meet there.
    """
    chunks = F.ceil(F.col("n") / chunk).cast("long")
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks))
    # The smallest ids lead wherever they are, and links to smaller ids contract in few rounds.
    dealt = dealt.repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk", "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys, signatures = batch["id"].to_numpy(), batch[["bucket", "chunk"]].to_numpy(), _signatures(batch)
            left = np.arange(len(batch))
            for _ in range(LEADERS):
                if not len(left):
                    break
                first = np.concatenate(([True], (keys[left[1:]] != keys[left[:-1]]).any(1)))
                leader = left[np.maximum.accumulate(np.where(first, np.arange(len(left)), 0))]
                agreed = (signatures[left] == signatures[leader]).sum(1)
                close = ~first & (agreed >= CLOSE)
                yield _pair_frame(ids[leader[close]], ids[left[close]])
                left = left[~first & ~close]

    return dealt.select("bucket", "chunk", "id", "signature").mapInPandas(run, "a long, b long").distinct()


def _pair_frame(one: np.ndarray, two: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": np.minimum(one, two), "b": np.maximum(one, two)}, dtype="int64")


CELL = ["bucket", "i", "j"]


def cells(rows: DataFrame, chunk: int = CHUNK, classes: DataFrame | None = None) -> DataFrame:
    """Texts of the buckets with several classes, dealt to cells (bucket, i, j) as hosts and guests.

    Texts outside the largest class of a bucket are guests; each meets every text of the bucket once.
    Without `classes` each text is one of its own. Rows without `words` are taken for long texts
    of equal length, without `bins` for equal ones, without `place` for such that meet once.
    """
    for name, value in (("words", F.lit(BRIEF)), ("bins", F.lit(b"\0")), ("place", F.lit(0).cast("short"))):
        if name not in rows.columns:
            rows = rows.withColumn(name, value)
    marked = rows.drop("n").withColumn("class_id", F.col("id"))
    if classes is not None:
        marked = rows.drop("n").join(classes, "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))
    held = marked.groupBy("bucket", "class_id").agg(F.count("*").alias("held"), F.sum("words").alias("held_words"))
    sizes = held.groupBy("bucket").agg(
        F.sum("held").alias("n"),
        F.sum("held_words").alias("n_words"),
        F.max(F.struct("held", "class_id", "held_words")).alias("most"),
        F.count("*").alias("classes"),
    )
    sizes = saved(sizes.filter("classes > 1").select("bucket", "n", "n_words", "most.*"), "mixed_buckets")
    sizes = sizes.withColumnRenamed("class_id", "major")
    dealt = marked.join(sizes, "bucket").withColumn("guest", F.col("class_id") != F.col("major"))

    def parts(n: Column, words: Column) -> Column:
        return F.ceil(F.greatest(n / chunk, words / CELL_WORDS)).cast("long")

    dealt = dealt.withColumn("hosts", parts(F.col("n"), F.col("n_words")))
    dealt = dealt.withColumn("guests", parts(F.col("n") - F.col("held"), F.col("n_words") - F.col("held_words")))
    zero, turn = F.lit(0).cast("long"), F.xxhash64("id")

    def cell(i: Column, j: Column, host: Column, guest: Column) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), host.alias("host"), guest.alias("guest"))

    yes, no = F.lit(True), F.lit(False)
    as_host = F.transform(F.sequence(zero, F.col("guests") - 1), lambda j: cell(F.pmod(turn, "hosts"), j, yes, no))
    as_guest = F.transform(F.sequence(zero, F.col("hosts") - 1), lambda i: cell(i, F.pmod(turn, "guests"), no, yes))
    several = F.when(F.col("guest"), F.concat(as_host, as_guest)).otherwise(as_host)
    alone = (F.col("hosts") == 1) & (F.col("guests") == 1)
    places = F.when(alone, F.array(cell(zero, zero, yes, F.col("guest")))).otherwise(several)
    columns = ["id", "class_id", "place", "signature", "bins", "words"]
    return dealt.select("bucket", *columns, F.explode(places).alias("cell")).select("bucket", "cell.*", *columns)


def _in_cells(dealt: DataFrame) -> DataFrame:
    return dealt.repartition(*CELL).sortWithinPartitions(*CELL)


def _meetings(part: pd.DataFrame, first_only: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(guest, hosts, tables they agree in) of the candidates of different classes in a cell.

    If `first_only`, without those that agree in SEEN tables before that of the bucket.
    """
    own, signatures, words = part["class_id"].to_numpy(), _signatures(part), part["words"].to_numpy()
    host, place = np.flatnonzero(part["host"].to_numpy()), int(part["place"].iloc[0])
    bins = part["bins"].tolist()
    for g in np.flatnonzero(part["guest"].to_numpy()).tolist():
        agreed, wanted = agreeing(signatures[g], int(words[g]), signatures[host], words[host])
        wanted &= own[host] != own[g]
        if first_only and place < TABLES:
            wanted &= (signatures[host, :place] == signatures[g, :place]).sum(1) < SEEN
        at = np.flatnonzero(wanted)
        if not len(at):
            continue
        longest = np.maximum(words[host[at]], words[g])
        edits = least_edits(bins[g], [bins[i] for i in host[at].tolist()])
        at = at[edits <= (1 - SIMILARITY) * longest + 1e-9]
        if len(at):
            yield g, host[at], agreed[at]


def candidate_pairs(
    rows: DataFrame, chunk: int = CHUNK, classes: DataFrame | None = None, best: bool = False
) -> DataFrame:
    """Distinct (a, b), a < b, of candidates of different classes, out of rows as `cells` takes them.

    If `best`, each text proposes one other at most. A pair whose word counts alone ask for
    too many edits stays in its cell.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _groups(batches, CELL):
            ids = part["id"].to_numpy()
            out, waiting = [], 0
            for g, hosts, agreed in _meetings(part, False):
                if best:
                    top = agreed.argmax()
                    hosts, agreed = hosts[top : top + 1], agreed[top : top + 1]
                out.append((np.full(len(hosts), ids[g]), ids[hosts], agreed))
                waiting += len(hosts)
                if waiting > 50_000:
                    yield _agreed_frame(out)
                    out, waiting = [], 0
            if out:
                yield _agreed_frame(out)

    found = _in_cells(cells(rows, chunk, classes)).mapInPandas(run, "one long, two long, agreed int")
    if best:
        found = found.groupBy("one").agg(F.max_by("two", F.struct("agreed", "two")).alias("two"))
    return found.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")).distinct()


def aligned_in_cell(part: pd.DataFrame) -> list[tuple[int, int, float]]:
    """(a, b, similarity) of links that join the classes of a cell whose rows hold their texts.

    An edit takes away at most one of a text's words, and two of its pairs of neighbouring words.
    Pairs of texts that share too few by that, or are linked through others already, are not
    aligned. Words, pairs and k-mers are numbered once for the cell, not for each pair of texts.
    """
    texts = [bytes(t) for t in part["text"]]
    words = [w for a, b in _blocks([len(t) for t in texts]) for w in word_hashes(texts[a:b])]
    single, double, longer = (Grams(words, size) for size in (1, SHINGLE, K))
    ids = part["id"].tolist()
    names, root = np.unique(part["class_id"].to_numpy(), return_inverse=True)
    above = list(range(len(names)))

    def top(c: int) -> int:
        while above[c] != c:
            above[c] = c = above[above[c]]
        return c

    sizes = part["words"].to_numpy()
    out = []
    for g, hosts, agreed in _meetings(part, True):
        longest = np.maximum(sizes[hosts], sizes[g])
        near = longest - single.shared(g, hosts)[0] <= (1 - SIMILARITY) * longest + 1e-9
        hosts, agreed, longest = hosts[near], agreed[near], longest[near]
        if not len(hosts):
            continue
        shortest = np.minimum(sizes[hosts], sizes[g])
        near = longest - 1 - double.shared(g, hosts)[0] <= 2 * ((1 - SIMILARITY) * longest + 1e-9)
        near |= shortest < SHINGLE
        hosts, agreed, shortest = hosts[near], agreed[near], shortest[near]
        order = np.argsort(-agreed, kind="stable")
        for h, least in zip(hosts[order].tolist(), shortest[order].tolist()):
            one, two = top(int(root[g])), top(int(root[h]))
            if one == two:
                continue
            if least < K:
                found = similarity(words[g], words[h])
            else:
                found = along_shared(words[g], words[h], K, *longer.shared(g, np.array([h]))[1:])
            if found > 0:
                above[max(one, two)] = min(one, two)
                out.append((min(ids[g], ids[h]), max(ids[g], ids[h]), found))
    return out


def cell_links(rows: DataFrame, texts: DataFrame, chunk: int = CHUNK, classes: DataFrame | None = None) -> DataFrame:
    """(a, b, similarity) of links between different classes, enough to hold together all that have one."""

    def meeting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _groups(batches, CELL):
            host, guest = np.zeros(len(part), bool), np.zeros(len(part), bool)
            for g, hosts, _ in _meetings(part, True):
                guest[g] = host[hosts] = True
            part = part.assign(host=host, guest=guest)
            yield part[host | guest]

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _groups(batches, CELL):
            yield pd.DataFrame(aligned_in_cell(part), columns=["a", "b", "similarity"])

    dealt = _in_cells(cells(rows, chunk, classes))
    met = saved(dealt.mapInPandas(meeting, dealt.schema), "met_rows")
    needed = saved(_needed(texts, met.select("id").distinct()), "needed_texts")
    return _in_cells(met.join(needed, "id")).mapInPandas(align, "a long, b long, similarity double")


def _needed(texts: DataFrame, ids: DataFrame) -> DataFrame:
    return texts.join(saved(ids, "needed_ids"), "id", "left_semi").dropDuplicates(["id"])


def _agreed_frame(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    one, two, agreed = (np.concatenate(x) for x in zip(*parts))
    return pd.DataFrame({"one": one, "two": two, "agreed": agreed.astype(np.int32)})


def near_links(sketched: DataFrame, texts: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(a, b, similarity) of near texts with a < b, as many as hold their classes together, and these as (id, class_id)."""
    rows = candidate_rows(sketched)

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        needed = saved(_needed(texts, ends), "needed_texts")
        return saved(verify(pairs, needed).filter("similarity > 0"), "links")

    tested = saved(close_pairs(rows, chunk), "pairs")
    led = verified(tested)
    classes = components(led)
    fresh = candidate_pairs(rows, chunk, classes, best=True).join(tested, ["a", "b"], "left_anti")
    best = verified(saved(fresh, "pairs"))
    classes = more_linked(classes, best)
    rest = saved(cell_links(rows, texts, chunk, classes), "links")
    return led.unionByName(best).unionByName(rest), more_linked(classes, rest)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, class_id (the smallest id of its class), kept."""
    ship_package(docs.sparkSession)
    plain = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    plain = plain.withColumn("text_hash", F.unhex(F.sha2("text", 256)))
    sketched = saved(sketch_texts(plain.select("id", "text_hash", "text")), "sketches")
    # A node for each distinct text; ids only name the result.
    first = sketched.groupBy("text_hash").agg(F.min("id").alias("first_id"))
    first = saved(first.withColumn("node", F.monotonically_increasing_id()), "nodes")
    heads = first.select(F.col("first_id").alias("id"), "text_hash", "node")
    alone = sketched.join(heads, ["id", "text_hash"]).dropDuplicates(["node"])
    unique = saved(alone.select(F.col("node").alias("id"), "buckets", "signature", "bins", "words"), "alone")
    # Rows that repeat id and text are several here; `near_links` takes one of those it needs.
    node_texts = plain.join(heads, ["id", "text_hash"]).select(F.col("node").alias("id"), "text")
    classes = near_links(unique, node_texts)[1].withColumnRenamed("id", "node")
    named = first.join(classes, "node", "left").withColumn("class_id", F.coalesce("class_id", "node"))
    # A class goes by its smallest id; of texts that share it, the one whose digest comes first stays.
    lowest = named.groupBy("class_id").agg(F.min(F.struct("first_id", "text_hash")).alias("low"))
    of_text = named.join(lowest, "class_id").select("text_hash", "low")
    own = sketched.select("id", "text_hash").join(of_text, "text_hash")
    is_low = (F.col("id") == F.col("low.first_id")) & (F.col("text_hash") == F.col("low.text_hash"))
    return own.select(
        F.nullif("id", F.lit(NULL_ID)).alias("doc_id"),
        F.nullif("low.first_id", F.lit(NULL_ID)).alias("class_id"),
        is_low.alias("kept"),
        "text_hash",
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: the rows that `near_duplicates` keeps."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_text"))
    kept = saved(kept.distinct(), "kept_ids")
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (digest == F.col("_kept_text"))
    return docs.join(kept, same, "left_semi")
