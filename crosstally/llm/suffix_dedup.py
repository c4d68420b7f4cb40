"""Remove passages that documents with smaller ids also hold, by sorted suffixes.

A passage is a string of SPAN bytes. Only some suffixes need sorting: of the tokens
(TOKEN bytes) inside a passage, the one with the smallest hash is its anchor, a choice
that depends on nothing but the passage. All copies of a passage thus have their anchor
at the same place, and one suffix for each anchor stands for all passages around it.

1. Documents are dealt to batches by the smallest hash of their tokens, so that most
   copies and near copies share a batch; texts of one such hash that are too large for a
   batch are cut by id. The passages of an anchor are told apart by the side of it that
   more of them lies on; those of a side have two thirds of their bytes in common, whose
   hash is their key. A batch sends its distinct keys to range buckets: sampled splitters
   cut the order of the anchors' tokens.
2. A bucket sorts its keys and answers which occur in several batches.
3. A batch sends the text around the anchors of these keys, each distinct context once
   with the smallest id that holds it, to the same ranges. A key of more than HOT
   contexts besides one a batch is cut further: STEP passages at a time travel alone,
   dealt by hash of the bytes they share.
4. A bucket sorts the passages of its contexts by multikey quicksort, eight bytes a key,
   and answers for each one whether a smaller document holds it. Equal passages share
   their anchor token or the bytes they are dealt by, so no run of equal passages crosses
   buckets. Keys that no other batch holds are settled inside their batch the same way.
5. A batch turns the answers into spans of its own documents.

Only keys, contexts and answers travel, one row for each batch and bucket; texts are
dealt once, compressed. A text held by a third of all documents costs each batch one copy of its
contexts. Results are exact: hashes choose and deal, bytes decide.

Results for odd input: a null text counts as empty; a null id is smaller than all
others; rows that repeat an id do not remove each other's bytes; texts below SPAN bytes
lose nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crosstally.llm.common import mix64, partitions, ship_package

SPAN = 50
TOKEN = 16
#: Passages of an anchor with more bytes than this before it are left of it, others right.
HALF = (SPAN - TOKEN) // 2
#: Contexts of a key, besides one a batch, beyond which its passages are dealt STEP at a time.
HOT = 1000
STEP = 7
#: What a batch knows of a key: one document holds it, several batches do, it is hot, or
#: several documents do of this batch only.
ALONE, SHARED, MANY, LOCAL = range(4)
BATCH_BYTES = 2 << 20
#: Little text is not cut further: each batch sends a row to each bucket.
LEAST_BATCH, LEAST_BUCKET = 1 << 16, 1 << 19
#: Documents, and tokens of each, that the splitters are sampled from.
SAMPLE_DOCS = 600
SAMPLE_TOKENS = 48
#: Window starts of one piece of a long text; a block of pieces stays below 2**24 bytes.
PIECE = 1 << 22
#: Bytes of the pieces worked on at once: their arrays of words stay in a core's cache.
BLOCK = 1 << 15
PLACE = np.uint64((1 << 24) - 1)
NULL_ID = -(1 << 63)


def words_at(data: bytes) -> np.ndarray:
    """At each place the next 8 bytes as one number, the first byte highest."""
    return np.ndarray(len(data) - 7, ">u8", data, strides=(1,)).astype(np.uint64)


class Block:
    """Anchored suffixes of some texts: groups of neighbouring passages with one anchor."""

    def __init__(self, pieces: Sequence[tuple[int, int, bytes]]):
        self.data = b"".join(part for _, _, part in pieces)
        sizes = np.array([len(part) for _, _, part in pieces])
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        word = words_at(self.data)
        mixed = mix64(word)
        token = mixed[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ mixed[8:]
        low = (token & ~PLACE) | np.arange(len(token), dtype=np.uint64)
        covered, window = 1, SPAN - TOKEN + 1
        while covered * 2 <= window:
            low = np.minimum(low[:-covered], low[covered:])
            covered *= 2
        if rest := window - covered:
            low = np.minimum(low[:-rest], low[rest:])
        passages = sizes - SPAN + 1
        of_piece = np.repeat(np.arange(len(pieces)), passages)
        within = np.arange(passages.sum()) - np.repeat(np.cumsum(passages) - passages, passages)
        starts = begins[of_piece] + within
        anchors = (low[starts] & PLACE).astype(np.int64)
        # Anchors never move back, so the passages of one side of an anchor are neighbours.
        left = anchors - starts > HALF
        moved = anchors[1:] != anchors[:-1]
        first = np.flatnonzero(np.concatenate(([True], moved | (left[1:] != left[:-1]))))
        self.begin = starts[first]
        self.count = np.diff(np.concatenate((first, [len(anchors)])))
        piece = of_piece[first]
        self.doc = np.array([d for d, _, _ in pieces])[piece]
        self.offset = np.array([o for _, o, _ in pieces])[piece] + within[first]
        self.at = at = anchors[first]
        # The bytes that all passages of a side hold, read as three tokens.
        left = left[first]
        second = np.where(left, at - HALF - 1 + TOKEN, at + TOKEN)
        third = np.where(left, at - HALF - 1, at + SPAN - HALF - TOKEN)
        self.key = mix64(token[at] + mix64(token[second] + mix64(token[third])))
        #: Contexts of a key differ outside the key's bytes, near their ends.
        self.edges = mix64(token[self.begin]) ^ token[self.begin + self.count + SPAN - 1 - TOKEN]
        self.head = np.stack((word[at], word[at + 8]), 1)


def blocks(texts: Sequence[bytes]) -> Iterator[Block]:
    pieces, size = [], 0
    for doc, text in enumerate(texts):
        for offset in range(0, len(text) - SPAN + 1, PIECE):
            part = text[offset : offset + PIECE + SPAN - 1]
            pieces.append((doc, offset, part))
            size += len(part)
            if size >= BLOCK:
                yield Block(pieces)
                pieces, size = [], 0
    if pieces:
        yield Block(pieces)


def _leading(heads: np.ndarray) -> np.ndarray:
    """Leading tokens as strings that sort by their bytes."""
    return np.ascontiguousarray(heads.astype(">u8")).view(f"S{TOKEN}").ravel()


class Batch:
    """The distinct keys of a batch, in the order (bucket, key)."""

    def __init__(self, texts: Sequence[bytes], splitters: np.ndarray):
        self.blocks = [*blocks(texts)]
        self.keys = np.empty(0, np.uint32)
        self.bucket = self.more = np.empty(0, np.int64)
        self.several = np.empty(0, bool)
        if not self.blocks:
            return
        doc = np.concatenate([b.doc for b in self.blocks])
        edges = np.concatenate([b.edges for b in self.blocks])
        new = np.concatenate([np.concatenate(([True], b.at[1:] != b.at[:-1])) for b in self.blocks])
        head = np.concatenate([b.head for b in self.blocks])[new]
        bucket = np.searchsorted(splitters, _leading(head), "right").astype(np.uint64)[np.cumsum(new) - 1]
        # Keys that fall together here are only taken for one more often: bytes decide later.
        key = bucket << np.uint64(32) | np.concatenate([b.key for b in self.blocks]) >> np.uint64(32)
        order = np.argsort(key)
        k = key[order]
        new = np.concatenate(([True], k[1:] != k[:-1]))
        first = np.flatnonzero(new)
        rank = np.cumsum(new) - 1
        self.keys = k[first].astype(np.uint32)
        self.bucket = (k[first] >> np.uint64(32)).astype(np.int64)
        holders = doc[order]
        self.several = np.minimum.reduceat(holders, first) != np.maximum.reduceat(holders, first)
        bits = np.uint64(64 - len(first).bit_length())
        context = np.sort(rank.astype(np.uint64) << bits | edges[order] >> (np.uint64(64) - bits))
        context = context[np.concatenate(([True], context[1:] != context[:-1]))]
        #: Distinct contexts of a key besides one, nearly exact.
        self.more = np.bincount((context >> bits).astype(np.int64), minlength=len(first)) - 1
        #: For each group of passages, in order: the place of its key.
        self.place = np.empty(len(key), np.int64)
        self.place[order] = rank

    def cuts(self) -> Iterator[tuple[int, int, int]]:
        """(bucket, from, to) of the stretches of keys."""
        yield from _stretches(self.bucket)


def _stretches(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(sorted_values):
        first = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(sorted_values)]):
            yield int(sorted_values[a]), a, b


def _classes(keys: np.ndarray, more: np.ndarray, hot: int) -> np.ndarray:
    """ALONE: a key of one batch, SHARED: of several, MANY: also of more than `hot` contexts besides one a batch."""
    order = np.argsort(keys)
    k = keys[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    held = np.diff(np.append(first, len(k)))
    total = np.add.reduceat(more[order], first)
    kind = np.where(held == 1, ALONE, np.where(total > hot, MANY, SHARED)).astype(np.uint8)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(kind, held)
    return out


class Contexts:
    """Distinct contexts of a batch by bucket, and where its documents hold them.

    Bucket 2 * buckets stands for the batch itself, whose own contexts are left out if not `local`.
    """

    def __init__(self, batch: Batch, classes: np.ndarray, buckets: int, local: bool):
        known: dict[bytes, int] = {}
        self.bucket: list[int] = []
        self.doc: list[int] = []  # the first document, which has the smallest id
        members: list[tuple[int, int, int, int]] = []
        kinds = np.where((classes == ALONE) & batch.several, LOCAL, classes) if local else classes
        at = 0
        for block in batch.blocks:
            place = batch.place[at : at + len(block.key)]
            at += len(block.key)
            kind = kinds[place]
            chosen = np.flatnonzero(kind != ALONE)
            if not len(chosen):
                continue
            # Both sides of an anchor that go the same way travel as one context.
            kind, anchor = kind[chosen], block.at[chosen]
            apart = (anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == MANY)
            first = np.flatnonzero(np.concatenate(([True], apart)))
            count = np.add.reduceat(block.count[chosen], first)
            kind, anchor, chosen = kind[first], anchor[first], chosen[first]
            to = np.where(kind == LOCAL, 2 * buckets, batch.bucket[place[chosen]])
            columns = (kind, anchor, block.begin[chosen], count, block.doc[chosen], block.offset[chosen], to)
            for kind, anchor, begin, count, doc, offset, bucket in zip(*(c.tolist() for c in columns)):
                for a, b in _steps(anchor - begin, count) if kind == MANY else ((0, count),):
                    context = block.data[begin + a : begin + b + SPAN - 1]
                    own = known.setdefault(context, len(known))
                    if own == len(self.doc):
                        self.doc.append(doc)
                        if kind == MANY:
                            ahead = (anchor - begin - a) // STEP * STEP
                            same = block.data[anchor - ahead : anchor - ahead + SPAN - STEP + 1]
                            bucket = buckets + zlib.crc32(same) % buckets
                        self.bucket.append(bucket)
                    members.append((own, doc, offset + a, b - a))
        self.texts = [*known]
        #: (context, document, offset of its first passage, passages), in order of the documents.
        self.members = np.array(members, np.int64).reshape(-1, 4)
        self.order = np.argsort(np.array(self.bucket, np.int64), kind="stable")

    def cuts(self) -> Iterator[tuple[int, int, int]]:
        yield from _stretches(np.array(self.bucket, np.int64)[self.order])


def _steps(ahead: int, count: int) -> Iterator[tuple[int, int]]:
    """Cut passages with `ahead` bytes and fewer before their anchor into those of one STEP: (from, to)."""
    a = 0
    while a < count:
        b = min(count, a + (ahead - a) % STEP + 1)
        yield a, b
        a = b


def multikey_runs(words: np.ndarray | Passages) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows by their columns from left to right: (order, starts of runs of equal rows).

    Rows that a column has told apart are not looked at again, and runs that a column finds
    equal are not sorted by it.
    """
    order = np.argsort(words[:, 0])
    value = words[order, 0]
    new = np.concatenate(([True], value[1:] != value[:-1], [True]))
    tied = np.flatnonzero(~(new[:-1] & new[1:]))
    for column in range(1, words.shape[1]):
        if not len(tied):
            break
        first, value = new[tied], words[order[tied], column]
        run = np.cumsum(first)
        differs = np.concatenate(([False], ~first[1:] & (value[1:] != value[:-1])))
        mixed = np.zeros(run[-1] + 1, bool)
        mixed[run[differs]] = True
        moved = np.flatnonzero(mixed[run])
        if not len(moved):
            continue
        at = tied[moved]
        value = value[moved]
        sorting = np.lexsort((value, run[moved]))
        order[at] = order[at][sorting]
        value = value[sorting]
        new[at[1:]] |= value[1:] != value[:-1]
        tied = tied[~(new[tied] & new[tied + 1])]
    return order, np.flatnonzero(new[:-1])


class Passages:
    """All passages of some texts as rows of 64-bit words, taken from the texts when they are read."""

    def __init__(self, texts: Sequence[bytes]):
        sizes = np.array([len(t) for t in texts])
        data = b"".join(texts)
        self.words = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))
        self.counts = sizes - SPAN + 1
        begins = np.cumsum(sizes) - sizes
        number = self.counts.sum()
        self.starts = np.repeat(begins - (np.cumsum(self.counts) - self.counts), self.counts) + np.arange(number)
        self.places = [*range(0, SPAN - 8, 8), SPAN - 8]  # the last word overlaps the one before
        self.shape = (number, len(self.places))

    def __getitem__(self, at: tuple[slice | np.ndarray, int]) -> np.ndarray:
        rows, column = at
        return self.words[self.starts[rows] + self.places[column]].astype(np.uint64)


def smaller_holders(texts: Sequence[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each passage of each context: does a document below the context's own hold it? And their numbers."""
    known: dict[bytes, int] = {}
    own = np.array([known.setdefault(text, len(known)) for text in texts], np.int64)
    owners = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(owners, own, docs)
    passages = Passages([*known])
    counts = passages.counts
    holder = np.repeat(owners, counts)
    order, first = multikey_runs(passages)
    held = holder[order]
    smallest = np.minimum.reduceat(held, first)
    below = np.empty(len(order), bool)
    below[order] = np.repeat(smallest, np.diff(np.append(first, len(order)))) < held
    begin = np.cumsum(counts) - counts
    n = counts[own]
    at = np.repeat(begin[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return below[at] | np.repeat(docs != owners[own], n), n


def planes(numbers: np.ndarray) -> bytes:
    """Bytes of one place together: the high ones of ids are alike, which compresses."""
    return numbers.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def packed(data: bytes) -> bytes:
    """Compressed if that is shorter: what Spark's own compression finds, repeats nearby, is rare in contexts."""
    out = pa.compress(data, codec="zstd", asbytes=True)
    return out if len(out) < len(data) else data


def unpacked(data: bytes, size: int) -> bytes:
    return data if len(data) == size else pa.decompress(data, size, codec="zstd", asbytes=True)


def merged(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the passages that begin at the sorted starts."""
    first = np.concatenate(([True], starts[1:] > starts[:-1] + SPAN))
    last = np.concatenate((first[1:], [True]))
    return starts[first], starts[last] + SPAN


def least_tokens(texts: Sequence[bytes]) -> list[int | None]:
    """The smallest hash of each text's tokens: copies have the same, near copies mostly. None if nothing can be cut."""
    out: list[int | None] = [None] * len(texts)
    held: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) >= SPAN:
            held.append(i)
            size += len(text)
        if held and (size >= BLOCK or i == len(texts) - 1):
            sizes = np.array([len(texts[j]) for j in held])
            word = words_at(b"".join(texts[j] for j in held))
            token = mix64(word[:-8] * np.uint64(0x9E3779B97F4A7C15) + word[8:])
            begin = np.cumsum(sizes) - sizes
            ends = begin + sizes - TOKEN + 1
            # A token over the end of a text is no token of it.
            least = np.minimum.reduceat(token, np.stack((begin, ends), 1).ravel()[:-1])[::2]
            for j, x in zip(held, least.view(np.int64).tolist()):
                out[j] = x
            held, size = [], 0
    return out


def dealt_alike(docs: DataFrame, batches: int, most: int) -> DataFrame:
    """Batch, id, size and packed text: texts of one smallest token hash share a batch, cut by id beyond `most` bytes."""

    @F.pandas_udf("long")
    def least(text: pd.Series) -> pd.Series:
        return pd.Series(least_tokens([bytes(x) for x in text]), dtype="Int64")

    @F.pandas_udf("least long, text binary")
    def pack(text: pd.Series) -> pd.DataFrame:
        texts = [bytes(x) for x in text]
        hashes = pd.Series(least_tokens(texts), dtype="Int64")
        return pd.DataFrame({"least": hashes, "text": [packed(x) for x in texts]})

    # Without nulls no filter on them is derived, which would hash all texts once more.
    signed = docs.select(F.coalesce(least("text"), F.lit(0)).alias("least"), F.length("text").cast("long").alias("size"))
    large = signed.groupBy("least").agg(F.sum("size").alias("size")).filter(F.col("size") > most)
    large = large.select("least", F.ceil(F.col("size") / most).alias("cuts"))
    own = docs.select("id", F.length("text").alias("size"), pack("text").alias("own")).select("id", "size", "own.*")
    own = own.withColumn("least", F.coalesce("least", F.xxhash64(F.lit(5), "id")))
    own = own.join(F.broadcast(large), "least", "left")
    cut = F.when(F.col("cuts").isNotNull(), F.pmod(F.xxhash64("id"), "cuts")).otherwise(0)
    return own.select(F.pmod(F.xxhash64("least", cut), F.lit(batches)).alias("batch"), "id", "size", "text")


def splitters(docs: DataFrame, rows: int, buckets: int) -> np.ndarray:
    """Leading tokens that cut the anchors of sampled documents into equal ranges."""
    share = max(1, rows // SAMPLE_DOCS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                heads = [b.head for b in blocks([bytes(text)])]
                if heads:
                    head = np.concatenate(heads)
                    found += [x.tobytes() for x in head[:: -(-len(head) // SAMPLE_TOKENS)].astype(">u8")]
            yield pd.DataFrame({"token": found})

    sample = docs.filter(F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(share)) == 0).select("text")
    tokens = sorted({bytes(r["token"]) for r in sample.mapInPandas(run, "token binary").collect()})
    cuts = tokens[:: max(1, math.ceil(len(tokens) / buckets))][1:]
    return np.array(cuts, f"S{TOKEN}")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the spans as span_from, span_to."""
    spark = docs.sparkSession
    ship_package(spark)
    plain = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    rows, size = plain.agg(F.count("*"), F.sum(F.length("text"))).first()
    tasks = partitions(spark)
    size = size or 1
    batches = max(min(3 * tasks, math.ceil(size / LEAST_BATCH)), math.ceil(size / BATCH_BYTES))
    buckets = min(4 * tasks, math.ceil(size / LEAST_BUCKET))
    cuts = splitters(plain, rows, buckets)
    dealt = dealt_alike(plain, batches, math.ceil(size / batches)).repartition(tasks, "batch")

    def texts_of(part: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
        part = part.sort_values("id", kind="stable")
        return part["id"].to_numpy(np.int64), [unpacked(bytes(t), n) for t, n in zip(part["text"], part["size"].tolist())]

    def send_keys(part: pd.DataFrame) -> pd.DataFrame:
        batch = Batch(texts_of(part)[1], cuts)
        more = np.minimum(batch.more, 65535).astype("<u2")
        out = [(bucket, batch.keys[a:b].tobytes() + more[a:b].tobytes()) for bucket, a, b in batch.cuts()]
        frame = pd.DataFrame(out, columns=["bucket", "data"])
        frame.insert(1, "batch", part["batch"].iloc[0])
        return frame

    def answer_keys(part: pd.DataFrame) -> pd.DataFrame:
        data = [bytes(x) for x in part["data"]]
        sizes = [len(x) // 6 for x in data]
        keys = np.concatenate([np.frombuffer(x[: 4 * n], np.uint32) for x, n in zip(data, sizes)])
        more = np.concatenate([np.frombuffer(x[4 * n :], "<u2") for x, n in zip(data, sizes)]).astype(np.int64)
        kinds = np.split(_classes(keys, more, hot), np.cumsum(sizes)[:-1])
        out = [x.tobytes() for x in kinds]
        return pd.DataFrame({"batch": part["batch"], "step": 1, "bucket": part["bucket"], "data": out})

    def read_classes(answers: pd.DataFrame) -> np.ndarray:
        own = answers[answers["step"] == 1].sort_values("bucket")
        return np.frombuffer(b"".join(bytes(x) for x in own["data"]), np.uint8)

    def send_contexts(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(part):
            ids, texts = texts_of(part)
            found = Contexts(Batch(texts, cuts), read_classes(answers), buckets, local=False)
            holders = ids[found.doc] if found.doc else ids[:0]
            for bucket, a, b in found.cuts():
                own = found.order[a:b].tolist()
                sizes = bytes(len(found.texts[i]) for i in own)
                data = packed(b"".join([found.texts[i] for i in own]))
                out.append((bucket, len(own), planes(holders[own]) + sizes + data))
        frame = pd.DataFrame(out, columns=["bucket", "n", "data"])
        frame.insert(1, "batch", part["batch"].iloc[0] if len(part) else 0)
        return frame

    def answer_contexts(part: pd.DataFrame) -> pd.DataFrame:
        texts, holders, counts = [], [], []
        for n, data in zip(part["n"], part["data"]):
            data = bytes(data)
            holders.append(from_planes(data[: 8 * n]))
            ends = np.cumsum(np.frombuffer(data[8 * n : 9 * n], np.uint8).astype(np.int64)).tolist()
            data, begin = unpacked(data[9 * n :], ends[-1]), 0
            for end in ends:
                texts.append(data[begin:end])
                begin = end
            counts.append(n)
        below, passages = smaller_holders(texts, np.concatenate(holders))
        ends = np.concatenate(([0], np.cumsum(passages)))[np.cumsum(counts)]
        out = [np.packbits(bits).tobytes() for bits in np.split(below, ends[:-1])]
        return pd.DataFrame({"batch": part["batch"], "step": 2, "bucket": part["bucket"], "data": out})

    def cut_spans(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        ids, texts = texts_of(part)
        spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        found = Contexts(Batch(texts, cuts), read_classes(answers), buckets, local=True)
        if len(found.members):
            passages = np.array([len(t) for t in found.texts]) - SPAN + 1
            bits = np.empty(passages.sum(), bool)
            begin = np.cumsum(passages) - passages
            replies = answers[answers["step"] == 2].set_index("bucket")["data"]
            for bucket, a, b in found.cuts():
                own = found.order[a:b]
                n = passages[own]
                places = np.repeat(begin[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                if bucket == 2 * buckets:
                    bits[places] = smaller_holders([found.texts[i] for i in own.tolist()], ids[found.doc][own])[0]
                else:
                    bits[places] = np.unpackbits(np.frombuffer(bytes(replies[bucket]), np.uint8), count=n.sum())
            context, doc, offset, count = found.members.T
            later = ids[doc] > ids[np.array(found.doc)][context]
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            gone = bits[np.repeat(begin[context], count) + within] | np.repeat(later, count)
            starts, of = (np.repeat(offset, count) + within)[gone], np.repeat(doc, count)[gone]
            spans = {d: merged(starts[a:b]) for d, a, b in _stretches(of)}
        out = []
        for i, text in enumerate(texts):
            begins, ends = spans.get(i, (np.empty(0, np.int64),) * 2)
            kept = hashlib.sha256()
            at = 0
            for a, b in zip(begins.tolist(), ends.tolist()):
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            removed = int((ends - begins).sum())
            out.append((int(ids[i]), len(text), removed, len(begins), kept.hexdigest(), begins, ends))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_from", "span_to"]
        return pd.DataFrame(out, columns=names)

    by_batch = dealt.groupBy("batch")
    answer = "batch long, step int, bucket long, data binary"
    keys = by_batch.applyInPandas(send_keys, "bucket long, batch long, data binary")
    classes = keys.groupBy("bucket").applyInPandas(answer_keys, answer)
    sent = by_batch.cogroup(classes.groupBy("batch")).applyInPandas(
        send_contexts, "bucket long, batch long, n long, data binary"
    )
    below = sent.groupBy("bucket").applyInPandas(answer_contexts, answer)
    both = classes.unionByName(below).groupBy("batch")
    result = by_batch.cogroup(both).applyInPandas(
        cut_spans,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
        " span_from array<long>, span_to array<long>",
    )
    return result.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))
