"""Phrase collocations by Toivonen mining.

A phrase is frequent if it occurs `min_count` times in its language. A bounded sample of
documents proposes phrases at a lowered threshold. The full pass then counts, exactly and
over all documents, every word and every longer phrase whose parts (the phrase without its
last and without its first word) were both proposed: the proposals and their negative
border. A frequent word or phrase that was not proposed is a failure of the border: phrases
that hold it may not have been counted. The phrases known to be frequent are then proposed
anew and a further pass counts what borders on them and was not counted before, until a
pass meets no failure. With phrases of three words that takes three passes at most.

Proposals travel as Bloom filters of fixed size, so what is broadcast does not grow with
the corpus. A filter may accept more than was proposed; this counts phrases that need not
be counted and loses none, and counts are exact in any case. A pass counts a phrase
only if no earlier pass did, by the filters that those used.

Tasks number the words of a window of text, count phrases as integers and send each phrase
of the window once, as text with its count; the shuffle adds them up by language and
phrase. A window is bounded in bytes, whatever the length of a text.

Results for odd input: a null text is empty; a null language is `und`, together with the
language of that name; a text without words adds nothing; repeated rows and ids count each;
ties in score go to the larger count and then to the phrase that comes first by its bytes;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from crosstally.llm.common import mix64, saved, ship_package
from crosstally.operators.skew import salted_join

NO_LANG = "und"
#: Bytes of text the sample holds, about; never more than a share of all text.
SAMPLE_BYTES = 32 << 20
SAMPLE_SHARE = 0.125
#: The sample's threshold, as a share of the one that its size would ask for, and the least.
LOWERED = 0.5
LEAST = 2
#: Text of one window at most, and of all windows that a task holds.
MOST_WINDOW_BYTES = 8 << 20
HELD_BYTES = 32 << 20
FILTER_BITS = 1 << 25
_BLOCK_BYTES = 1 << 12
_HASHES = 3

_PIECE_ENDS = b".,;:!?\n\v\f\r"
#: Byte by byte: A-Z in lower case, each piece end as a full stop, a tab as a blank.
_PLAIN = bytes(
    ord(".") if b in _PIECE_ENDS else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_BREAK = 0


class Proposals:
    """Bloom filters of phrases by their number of words; without filters everything is proposed."""

    def __init__(self, bits: dict[int, np.ndarray] | None = None):
        self.bits = bits

    def holds(self, words: int, hashes: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(hashes), bool)
        held = np.full(len(hashes), words in self.bits)
        if words in self.bits:
            for slots in filter_slots(hashes):
                held &= (self.bits[words][slots >> 3] >> (slots & 7).astype(np.uint8) & np.uint8(1)).astype(bool)
        return held


def word_hashes(lang: bytes, words: Sequence[bytes]) -> np.ndarray:
    digest, key = xxhash.xxh3_64_intdigest, lang + b"\n"
    return np.array([digest(key + w) for w in words], np.uint64)


def longer_hashes(phrases: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases that go on with a word, from the hashes of both."""
    return mix64(phrases * np.uint64(0x9E3779B97F4A7C15) + words)


def filter_slots(hashes: np.ndarray) -> list[np.ndarray]:
    """Places of phrases in a filter, an array for each hash function."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return [((low + np.uint64(i) * high) % np.uint64(FILTER_BITS)).astype(np.int64) for i in range(_HASHES)]


def phrase_hashes(lang: bytes, phrases: Sequence[bytes]) -> np.ndarray:
    """Hashes of phrases of equally many words."""
    columns = list(zip(*(p.split(b" ") for p in phrases)))
    hashes = word_hashes(lang, columns[0])
    for column in columns[1:]:
        hashes = longer_hashes(hashes, word_hashes(lang, column))
    return hashes


def window_bytes(longest: int) -> int:
    """Text a window may hold so that phrases fit 63 bits as numbers to the base of its distinct words.

    A word and its blank take two bytes, and there are too few words of one or two bytes for
    a window of 2.5 bytes a word to hold more distinct ones than that.
    """
    return min(MOST_WINDOW_BYTES, int(2.5 * 2 ** (63 / longest)))


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """A text in slices that end before a blank or a piece end, so that no word is cut."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and text[end] not in b" .":
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


class _Counter:
    """Counts the phrases of a window of text of one language.

    `carried` words of the window before lead in; phrases within them were counted there.
    """

    def __init__(self, carried: Sequence[bytes] = ()):
        self.parts = [b". ", *(w + b" " for w in carried)]
        self.carried = len(self.parts)
        self.size = 0

    def add(self, part: bytes) -> None:
        self.parts.append(part.replace(b".", b" . "))
        self.size += len(part)

    def _split(self) -> pa.DictionaryArray:
        """The window's words; a full stop, the first of them, stands between pieces."""
        text = pa.array([b"".join([*self.parts, b" ."])], pa.binary()).cast(pa.string())
        return pc.ascii_split_whitespace(text).flatten().dictionary_encode()

    def last(self, words: int) -> list[bytes]:
        return [w.as_py().encode() for w in self._split()[:-1][-words:]] if words else []

    def counts(
        self, longest: int, lang: bytes, now: Proposals, before: Sequence[Proposals]
    ) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(words, phrases, counts) by number of words; words themselves count in the first pass alone."""
        split = self._split()
        words, stream = split.dictionary, split.indices.to_numpy().astype(np.int64)
        if not before:
            totals = np.bincount(stream[self.carried :], minlength=len(words))
            totals[_BREAK] = 0
            used = np.flatnonzero(totals)
            yield 1, words.take(pa.array(used)), totals[used]
        # For each place of the stream the phrase that starts there, its hash, and which pass proposed it.
        of_word = word_hashes(lang, [w.encode() for w in words.to_pylist()])
        kind, hashes = stream, of_word[stream]
        held_at = []
        for p in [now, *before]:
            held = p.holds(1, of_word)
            held[_BREAK] = False
            held_at.append(held[stream])
        for size in range(2, longest + 1):
            fits = [h[:-1] & h[1:] for h in held_at]
            if not len(fits[0]):
                return
            counted = fits[0] & ~np.logical_or.reduce([*fits[1:], np.zeros(len(fits[0]), bool)])
            counted[: max(0, self.carried - size + 1)] = False
            following = stream[size - 1 :]
            kind = kind[: len(following)] * len(words) + following
            found, n = np.unique(kind[counted], return_counts=True)
            yield size, self._texts(found, size, words), n
            if size < longest:
                hashes = longer_hashes(hashes[: len(following)], of_word[following])
                held_at = []
                for fit, p in zip(fits, [now, *before]):
                    places = np.flatnonzero(fit)
                    at = np.zeros(len(fit), bool)
                    at[places] = p.holds(size, hashes[places])
                    held_at.append(at)

    def _texts(self, kinds: np.ndarray, size: int, words: pa.Array) -> pa.Array:
        columns = []
        for _ in range(size):
            kinds, last = np.divmod(kinds, len(words))
            columns.append(words.take(pa.array(last)))
        return pc.binary_join_element_wise(*reversed(columns), " ")


def _pass(docs: DataFrame, longest: int, now: Proposals, before: Sequence[Proposals]) -> DataFrame:
    """Exact counts (key, f) of what `now` proposes and borders on, without what came before.

    A key is the language, a line feed and the phrase; an empty phrase goes with the number
    of words of the language.
    """
    shared = docs.sparkSession.sparkContext.broadcast((now, list(before)))
    window = window_bytes(longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, _Counter] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                lang = lang.as_py().encode()
                for part in _slices(text.as_py().translate(_PLAIN), window // 8):
                    counter = counters.setdefault(lang, _Counter())
                    counter.add(part)
                    held += len(part)
                    if counter.size >= window - window // 8:
                        yield from sent(lang, counter)
                        held -= counter.size
                        counters[lang] = _Counter(counter.last(longest - 1))
                counters[lang].add(b".")
                if held >= HELD_BYTES:
                    for name, counter in counters.items():
                        yield from sent(name, counter)
                    counters, held = {}, 0
        for name, counter in counters.items():
            yield from sent(name, counter)

    def sent(lang: bytes, counter: _Counter) -> Iterator[pa.RecordBatch]:
        key = pa.scalar(lang.decode() + "\n")
        for words, phrases, n in counter.counts(longest, lang, *shared.value):
            if words == 1:
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()]), pa.array([int(n.sum())])], names=["key", "n"])
            keys, n = pc.binary_join_element_wise(key, phrases, ""), pa.array(n.astype(np.int64))
            for at in range(0, len(keys), 1 << 18):
                yield pa.RecordBatch.from_arrays([keys[at : at + (1 << 18)], n[at : at + (1 << 18)]], names=["key", "n"])

    return docs.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("f"))


def _named(counted: DataFrame) -> DataFrame:
    """(lang, words, phrase, f) from counts by key. A phrase has no line feed, so the last one parts the key."""
    key, phrase = F.col("key"), F.substring_index("key", "\n", -1)
    words = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ")))
    lang = F.substring(key, F.lit(1), F.length(key) - F.length(phrase) - 1)
    return counted.select(lang.alias("lang"), words.alias("words"), phrase.alias("phrase"), "f")


def _filters(known: DataFrame) -> Proposals:
    """Bloom filters of (lang, words, phrase) rows, put together block by block on the executors."""
    block_bits = 8 * _BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            for (lang, words), part in batch.to_pandas().groupby(["lang", "words"]):
                field = bits.setdefault(int(words), np.zeros(FILTER_BITS, bool))
                for slots in filter_slots(phrase_hashes(lang.encode(), [p.encode() for p in part["phrase"]])):
                    field[slots] = True
        for words, field in bits.items():
            blocks = np.packbits(field.reshape(-1, block_bits), axis=1, bitorder="little")
            touched = np.flatnonzero(blocks.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(touched), words, np.int32)), pa.array(touched),
                 pa.array([blocks[i].tobytes() for i in touched], pa.binary())],
                names=["words", "block", "bits"],
            )

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in part["bits"]])
        return part.head(1).assign(bits=[bits.tobytes()])

    shape = "words int, block long, bits binary"
    sent = known.select("lang", "words", "phrase").mapInArrow(run, shape)
    whole: dict[int, np.ndarray] = {}
    for row in sent.groupBy("words", "block").applyInPandas(merged, shape).collect():  # FILTER_BITS for each length
        field = whole.setdefault(row["words"], np.zeros(FILTER_BITS // 8, np.uint8))
        field[row["block"] * _BLOCK_BYTES :][:_BLOCK_BYTES] = np.frombuffer(row["bits"], np.uint8)
    return Proposals(whole)


def _any_missed(known: DataFrame, used: Proposals, longest: int) -> bool:
    """Whether a frequent phrase that a longer one could hold was not proposed."""
    shared = known.sparkSession.sparkContext.broadcast(used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (lang, words), part in batch.to_pandas().groupby(["lang", "words"]):
                held = shared.value.holds(words, phrase_hashes(lang.encode(), [p.encode() for p in part["phrase"]]))
                if not held.all():
                    yield pa.RecordBatch.from_arrays([pa.array([int((~held).sum())])], names=["missed"])

    shorter = known.filter(F.col("words").between(1, longest - 1)).select("lang", "words", "phrase")
    return not shorter.mapInArrow(run, "missed long").isEmpty()


def frequent_phrases(
    docs: DataFrame, min_count: int = 10, longest: int = 3, sample_bytes: int = SAMPLE_BYTES, share: float = SAMPLE_SHARE
) -> DataFrame:
    """(lang, words, phrase, f): all phrases of up to `longest` words that occur `min_count` times, counted exactly.

    A row with words = 0 holds the number of words of each language.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text.cast("binary").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    taken = min(share, sample_bytes / max(1, size))
    dealt = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(taken * (1 << 20))
    sampled = _pass(own.filter(dealt), longest, Proposals(), ())
    lowered = max(LEAST, LOWERED * min_count * taken)
    now = _filters(_named(sampled.filter(F.col("f") >= lowered)).filter(F.col("words").between(1, longest - 1)))
    before: list[Proposals] = []
    known = None
    while True:
        counted = _pass(own, longest, now, before)
        found = counted.filter((F.col("f") >= min_count) | F.col("key").endswith("\n"))
        found = saved(_named(found), f"phrases_{len(before)}")
        known = found if known is None else known.unionByName(found)
        if not _any_missed(known, now, longest):
            return known
        before.insert(0, now)
        now = _filters(known.filter(F.col("words").between(1, longest - 1)))


def collocations(
    docs: DataFrame, min_count: int = 10, longest: int = 3, kept_share: int = 50, top: int | None = 2000, scale: int = 1_000_000, **options
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of 2 to `longest` words that hold together best.

    A phrase's score is that of its weakest cut, scale * a * a / (l * r), rounded down. A
    phrase inside a longer candidate that has at least `kept_share` percent of its
    occurrences is dropped. With `top` the first so many of each language are returned.
    """
    known = frequent_phrases(docs, min_count, longest, **options)
    f = known.filter("words > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("f"))
    candidates = saved(
        known.filter("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w")), "candidates"
    )

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("w", start, length), " ")

    cut, one = F.col("cut"), F.lit(1)
    cuts = candidates.withColumn("cut", F.explode(F.sequence(one, F.col("words") - 1)))
    sides = cuts.select(
        "lang", "phrase", "a", "cut",
        F.explode(F.array(
            F.struct(F.lit("l").alias("side"), part(one, cut).alias("part")),
            F.struct(F.lit("r").alias("side"), part(cut + 1, F.col("words") - cut).alias("part")),
        )).alias("x"),
    ).select("lang", "phrase", "a", "cut", "x.side", "x.part")
    counted = salted_join(sides, f, ["lang", "part"], "inner", salts=4)
    both = counted.groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r")
    )
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    score = F.call_function("div", wide["a"] * wide["a"] * F.lit(scale).cast("decimal(10,0)"), wide["l"] * wide["r"])
    weakest = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("weakest")
    )
    # Parts of two words and more of each candidate, with the candidate's count.
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    inner = candidates.filter("words > 2").withColumn("length", F.explode(lengths))
    inner = inner.withColumn("start", F.explode(F.sequence(one, F.col("words") - F.col("length") + 1)))
    around = inner.groupBy("lang", part(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("around"))
    kept = weakest.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * kept_share)
    )
    order = Window.partitionBy("lang").orderBy(F.col("weakest.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    n = known.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score")
