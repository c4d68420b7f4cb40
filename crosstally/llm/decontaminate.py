"""Benchmark decontamination with an Aho-Corasick automaton over benchmark windows.

Texts are normalised to words: A-Z become lower case, every other ASCII character that is
no letter or digit separates. A window is ten consecutive words of a benchmark item; an
item of fewer words, but not none, is one window. The automaton's alphabet are the words of
the benchmark: a document becomes one symbol a word (words the benchmark lacks share a
symbol that no window has) and is scanned once for all windows. Word positions lead back
to places in the original text, so that hits can be shown or cut.

Documents are scanned where they lie, without a shuffle. An automaton has at most ten nodes
for each benchmark word, and a word takes at most LONG_WORD bytes (longer ones go by their
SHA-256), so SHARD_WORDS bounds what is broadcast. A larger benchmark is dealt to several
automata by hash, in segments that overlap by nine words. Each then scans the documents,
and what they found is put together per document by an aggregate that sends hits only.

Results for odd input: a null or empty text has no words and no hits; an item without words
has no window; rows that repeat an item id are one item with the windows of all of them; a
null item id counts as an item and is written as an empty string; rows that repeat a doc_id
are judged each; an empty benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crosstally.llm.common import ship_package

WINDOW = 10
SHARD_WORDS = 200_000
#: Words of an item that are dealt to an automaton together.
SEGMENT = 2_000
LONG_WORD = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Byte by byte: lower case, and a blank for what separates. Bytes above 127 belong to words.
_NORMAL = bytes(
    ord(chr(b).lower()) if chr(b) in _UPPER else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
)
#: The symbol of words that no window holds; symbols of windows follow.
_OTHER = 1
_SURROGATES = range(0xD800, 0xE000)


def segments(benchmark: DataFrame, window: int = WINDOW, segment: int = SEGMENT) -> DataFrame:
    """(item_id string, words array): normalised items in segments that overlap by window - 1 words."""
    words = F.regexp_extract_all(F.translate(F.col("text"), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))
    short = F.transform(
        words, lambda w: F.when(F.octet_length(w) > LONG_WORD, F.concat(F.lit("#"), F.sha2(w, 256))).otherwise(w)
    )
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), short.alias("words"))
    items = items.filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    cut = items.withColumn("_from", F.explode(F.sequence(F.lit(0), last, F.lit(segment))))
    return cut.select("item_id", F.slice("words", F.col("_from") + 1, segment + window - 1).alias("words"))


def normal_words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text; very long ones by digest."""
    words = text.translate(_NORMAL).split()
    if words and len(max(words, key=len)) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"#" + hashlib.sha256(w).hexdigest().encode() for w in words]
    return words


class Windows:
    """Automaton over the windows of some segments: which items' windows occur where in a text?"""

    def __init__(self, rows: list[tuple[str, list[str]]], window: int = WINDOW):
        import ahocorasick

        self.symbol: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton()
        for item, words in rows:
            text = "".join(self._symbol(w.encode()) for w in words)
            for start in range(max(1, len(text) - window + 1)):
                key = text[start : start + window]
                if key not in self.automaton:
                    self.automaton.add_word(key, (len(key), set()))
                self.automaton.get(key)[1].add(item)
        if rows:
            self.automaton.make_automaton()

    def _symbol(self, word: bytes) -> str:
        if word not in self.symbol:
            code = _OTHER + 1 + len(self.symbol)
            self.symbol[word] = chr(code if code < _SURROGATES.start else code + len(_SURROGATES))
        return self.symbol[word]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """(runs of hit words as rows of first and last + 1, ids of the items found)."""
        found: set[str] = set()
        if not self.symbol:
            return np.zeros((0, 2), np.int64), found
        symbol, other = self.symbol.get, chr(_OTHER)
        steps = np.zeros(len(words) + 1, np.int32)
        for end, (size, items) in self.automaton.iter("".join([symbol(w, other) for w in words])):
            steps[end + 1 - size] += 1
            steps[end + 1] -= 1
            found |= items
        return (runs(steps.cumsum()[:-1] > 0) if found else np.zeros((0, 2), np.int64)), found


def runs(hit: np.ndarray) -> np.ndarray:
    """(first, last + 1) of each stretch of true values."""
    edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)


def places(text: bytes, stretches: np.ndarray) -> np.ndarray:
    """Code point ranges of the original text that stretches of words take."""
    is_word = np.frombuffer(text.translate(_NORMAL), np.uint8) != 32
    words = runs(is_word)
    first_byte = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    point = np.concatenate(([0], first_byte.cumsum()))
    return np.stack([point[words[stretches[:, 0], 0]], point[words[stretches[:, 1] - 1, 1]]], 1)


_loaded: dict[str, Windows] = {}


def _windows(name: str, shared, window: int) -> Windows:
    """The automaton of a broadcast shard, built once per worker; a worker holds one at a time."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Windows(shared.value, window)
    return _loaded[name]


def _scan(docs: DataFrame, rows: list[tuple[str, list[str]]], window: int, hits_only: bool, with_digest: bool) -> DataFrame:
    shared, name = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _windows(name, shared, window)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            keep, out = [], []
            for i, text in enumerate(texts):
                text = text.as_py() or b""
                words = normal_words(text)
                stretches, items = automaton.scan(words)
                if hits_only and not items:
                    continue
                where = places(text, stretches) if items else np.zeros((0, 2), np.int64)
                digest = hashlib.sha256(text).digest() if with_digest else None
                keep.append(i)
                out.append((len(words), stretches, where, sorted(items), digest))
            if not keep:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep)),
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([[{"word": int(a), "word_end": int(b), "start": int(c), "end": int(d)}
                               for (a, b), (c, d) in zip(o[1], o[2])] for o in out], _SPANS),
                    pa.array([o[3] for o in out], pa.list_(pa.string())),
                    pa.array([o[4] for o in out], pa.binary()),
                ],
                names=["doc_id", "n_words", "spans", "items", "digest"],
            )

    spans = "array<struct<word:long,word_end:long,start:long,end:long>>"
    return docs.mapInArrow(
        run, f"doc_id {id_type}, n_words long, spans {spans}, items array<string>, digest binary"
    )


_SPANS = pa.list_(pa.struct([(n, pa.int64()) for n in ("word", "word_end", "start", "end")]))


def find_windows(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Per document: doc_id, n_words, spans, items.

    `spans` are the stretches of hit words, in order: their words (from 0) and their
    code points in the original text, ends exclusive. `items` are the ids, as strings and
    sorted as such, of the items with a window in the text.
    """
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    cut = segments(benchmark, window, min(SEGMENT, shard_words)).distinct()
    shards = _shard_count(cut, shard_words)
    dealt = cut.withColumn("_shard", F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)))

    def rows_of(shard: int) -> list[tuple[str, list[str]]]:
        own = dealt.filter(F.col("_shard") == shard).select("item_id", "words")
        return [(r["item_id"], r["words"]) for r in own.toLocalIterator()]

    if shards == 1:
        return _scan(narrow, rows_of(0), window, False, False).drop("digest")
    scans = [_scan(narrow, rows_of(s), window, s > 0, True).withColumn("_base", F.lit(s == 0)) for s in range(shards)]
    together = scans[0]
    for scan in scans[1:]:
        together = together.unionByName(scan)
    # Rows of equal id and text found the same; they are put together once and then repeated.
    merged = together.groupBy("doc_id", "digest").agg(
        F.count_if("_base").alias("_rows"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    repeated = merged.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows"))))
    return repeated.select("doc_id", "n_words", _joined("spans").alias("spans"), "items")


def _joined(spans: str):
    """Stretches of several scans in order; those that overlap or touch become one."""
    none = F.filter(spans, lambda s: F.lit(False))

    def add(done, s):
        last = F.element_at(done, -1)
        whole = F.struct(
            last["word"].alias("word"),
            F.greatest(last["word_end"], s["word_end"]).alias("word_end"),
            last["start"].alias("start"),
            F.greatest(last["end"], s["end"]).alias("end"),
        )
        apart = (F.size(done) == 0) | (s["word"] > F.try_element_at(done, F.lit(-1))["word_end"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(whole))
        )

    return F.aggregate(F.array_sort(spans), none, add)


def _shard_count(cut: DataFrame, shard_words: int) -> int:
    """The least power of two of shards that keeps each within the bound, or near the largest segment."""
    weight = (F.size("words") + 10).alias("weight")  # a segment costs something besides its words
    own = cut.select(F.xxhash64("item_id", "words").alias("h"), weight)
    shards = 1
    while True:
        sizes = own.groupBy(F.pmod("h", F.lit(shards)).alias("shard")).agg(F.sum("weight").alias("weight"))
        largest = sizes.agg(F.max("weight")).first()[0] or 0
        lone = own.agg(F.max("weight")).first()[0] if shards > 1 else 0
        if largest <= max(shard_words, 2 * (lone or 0)):
            return shards
        shards *= 2


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items, contaminated, spans."""
    found = find_windows(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["word_end"] - s["word"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", (F.size("spans") > 0).alias("contaminated"), "spans")
