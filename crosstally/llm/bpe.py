"""Byte-level BPE by a sentencepiece model serialised straight from a rank file.

Each token of the rank file becomes a piece: its bytes mapped one to one to printable
characters, scored by its negative rank, with identity normalisation. Merging by best
score then is merging by lowest rank. Texts are split into pre-tokens, each is encoded
by itself, and ids are decoded by the inverse map. Nothing is trained.

Results for odd input: a null text counts as empty and gives no ids; ties and repeated
rows are encoded alike, row by row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from crosstally.llm.common import ship_package

#: Pre-tokens a worker remembers; the memory is emptied when it is full.
REMEMBERED = 150_000
#: Bytes of ids that a worker hands back at once.
BLOCK = 1 << 21


def byte_characters() -> list[str]:
    """The character for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


def read_ranks(data: bytes) -> list[bytes]:
    """Tokens of a rank file, by rank; ranks must run from 0 without gaps."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, data.splitlines())}
    if sorted(ranks) != [*range(len(ranks))]:
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: varint for int, fixed 32 bits for float, else bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value & (1 << 64) - 1)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; the last id is the unknown piece."""
    # Field numbers of sentencepiece_model.proto: a fixed format.
    normal, unknown, bpe = 1, 2, 2
    chars = byte_characters()
    pieces = [("".join(chars[b] for b in token).encode(), -float(rank), normal) for rank, token in enumerate(tokens)]
    pieces.append((b"<unk>", -float(len(tokens)), unknown))
    body = b"".join(
        _field(1, _field(1, piece) + _field(2, score) + _field(3, kind)) for piece, score, kind in pieces
    )
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(tokens))
    trainer += b"".join(_field(n, -1) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return body + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        self.split = regex.compile(pattern).findall
        self.chars = dict(enumerate(byte_characters()))
        self.memory: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.split(text)
        known = self.memory
        if fresh := [p for p in dict.fromkeys(parts) if p not in known]:
            if len(known) + len(fresh) > REMEMBERED:
                known.clear()
                fresh = [*dict.fromkeys(parts)]
            mapped = [p.encode().decode("latin-1").translate(self.chars) for p in fresh]
            for part, ids in zip(fresh, self.processor.encode(mapped, num_threads=1)):
                known[part] = np.asarray(ids, "<u4").tobytes()
        return b"".join(map(known.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load_codec(vocabulary: str, pattern: str) -> Codec:
    """One codec per worker process."""
    with open(vocabulary, "rb") as file:
        return Codec(read_ranks(file.read()), pattern)


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode each text: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked, ids.

    `ids` holds the ids as little-endian unsigned 32-bit integers, in one binary value.
    `vocabulary` is the path of a rank file that every executor can open.
    """

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + with_ids]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = load_codec(vocabulary, pattern)
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = codec.encode(text or "")
                decoded = hashlib.sha256(codec.decode(ids)).hexdigest()
                rows.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded, ids)[: len(names)])
                size += len(ids)
                if size > BLOCK:
                    yield _frame(rows, names)
                    rows, size = [], 0
            yield _frame(rows, names)

    ship_package(docs.sparkSession)
    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    # Ids travel as text: pandas would turn integers beside nulls into floats.
    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").alias("text"))
    encoded = texts.mapInPandas(run, schema + ", ids binary" * with_ids)
    return encoded.withColumn("doc_id", F.col("doc_id").cast("long"))


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"doc_id": object, "n_tokens": "int64"})
