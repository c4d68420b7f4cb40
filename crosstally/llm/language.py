"""Language identification with a string kernel.

The kernel of two texts counts the n-grams of one to `ORDERS` bytes (UTF-8, lower case) that both hold
(presence, not frequency), divided by the geometric mean of their own counts. Landmark
texts give Nystroem features, and kernel ridge regression fits one 0/1 target for each
language on them. As the kernel is linear in presence vectors, landmarks, Nystroem
whitening and ridge weights fold into one matrix: scoring a batch is one matrix product
of its presence rows with that matrix.

The fit uses at most `PER_LANGUAGE` labelled rows of each language, those with the
smallest hash of their id, at whole length; it is the only step that samples. The fitted
matrix has `SLOTS` rows and a column for each language, whatever the corpus holds.

Results for odd input: a null text or one without a letter is `und` with score 0; if no
row is labelled, all are; ties go to the language that sorts first; equal texts always
get equal answers; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from crosstally.llm.common import ship_package

UND = "und"
#: Longest n-gram, in bytes; n-grams beyond one byte share slots by hash.
ORDERS = 4
SLOTS = 1 << 15
#: Labelled rows for the fit, and landmarks among them, of each language.
PER_LANGUAGE = 300
LANDMARKS = 60
RIDGE = 1e-3
#: Bytes of text whose presence rows are scored together.
BLOCK = 1 << 20


def presence_slots(text: bytes) -> np.ndarray:
    """Sorted slots of the n-grams that a text holds."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    held = np.zeros(SLOTS, bool)
    held[data] = True
    code = data
    for n in range(2, ORDERS + 1):
        if len(data) < n:
            break
        code = code[:-1] * np.uint32(257) + data[n - 1 :]
        mixed = (code + np.uint32(n)) * np.uint32(2654435761)
        held[256 + (mixed >> np.uint32(17)) % np.uint32(SLOTS - 256)] = True
    return np.flatnonzero(held)


@dataclass(frozen=True)
class KernelModel:
    """Languages in order, and the folded matrix with a column for each."""

    languages: list[str]
    weights: np.ndarray

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Best language and its score in 0..1 of each text."""
        scores = np.zeros((len(texts), max(1, len(self.languages))), np.float32)
        rows = [presence_slots(t.lower().encode()) for t in texts]
        for start in range(0, len(rows), 256):
            part = rows[start : start + 256]
            sizes = np.array([len(r) for r in part])
            dense = np.zeros((len(part), SLOTS), np.float32)
            dense[np.repeat(np.arange(len(part)), sizes), np.concatenate(part)] = 1
            scores[start : start + 256] = dense @ self.weights / np.sqrt(np.maximum(sizes, 1))[:, None]
        best = scores.argmax(1)
        return [self.languages[i] for i in best], np.clip(scores[np.arange(len(best)), best], 0, 1).astype(float)


def fit(rows: list[tuple[str, np.ndarray]]) -> KernelModel:
    """Fit on (language, presence slots) rows; their order decides the landmarks."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return KernelModel([], np.zeros((SLOTS, 1), np.float32))
    normed = np.zeros((len(rows), SLOTS), np.float32)
    for i, (_, slots) in enumerate(rows):
        normed[i, slots] = 1 / np.sqrt(max(1, len(slots)))
    of = {lang: [i for i, (x, _) in enumerate(rows) if x == lang] for lang in languages}
    landmarks = normed[[i for lang in languages for i in of[lang][:LANDMARKS]]]
    kernel = (landmarks @ landmarks.T).astype(float)
    values, vectors = np.linalg.eigh(kernel)
    usable = values > values.max() * 1e-6
    whiten = vectors[:, usable] / np.sqrt(values[usable])
    features = (normed @ landmarks.T).astype(float) @ whiten
    targets = np.array([[float(x == lang) for lang in languages] for x, _ in rows])
    gram = features.T @ features + RIDGE * len(rows) * np.eye(features.shape[1])
    ridge = np.linalg.solve(gram, features.T @ targets)
    return KernelModel(languages, (landmarks.T.astype(float) @ (whiten @ ridge)).astype(np.float32))


def train(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> KernelModel:
    """Fit on the rows for which `usable` holds; text and language must not be null.

    At most PER_LANGUAGE rows of a language are read for their text. Only their packed
    presence bits, SLOTS / 8 bytes a row, come to the driver.
    """
    ship_package(docs.sparkSession)
    labelled = docs.filter(usable & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = labelled.select(F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"))
    chosen = ids.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= PER_LANGUAGE)
    wanted = chosen.select(F.col("doc_id").alias("_id")).distinct()
    rows = labelled.select(F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(wanted), F.col("doc_id") == F.col("_id"), "left_semi")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = []
            for value in batch["text"]:
                held = np.zeros(SLOTS, bool)
                held[presence_slots(value.lower().encode())] = True
                bits.append(np.packbits(held).tobytes())
            yield pd.DataFrame({"lang": batch["lang"], "h": batch["h"], "bits": bits})

    keyed = rows.select("lang", F.xxhash64("doc_id").alias("h"), "text")
    packed = keyed.mapInPandas(pack, "lang string, h long, bits binary")
    found = sorted((r["lang"], r["h"], bytes(r["bits"])) for r in packed.collect())
    return fit([(x, np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8)))) for x, _, b in found])


def predictor(spark: SparkSession, model: KernelModel, text: str = "text") -> Column:
    """A column struct<lang_pred, score> that reads the whole text and nothing else."""
    ship_package(spark)
    schema = "lang_pred string, score double"
    if not model.languages:
        return F.struct(F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((model.languages, model.weights))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = KernelModel(*shared.value)
        for batch in batches:
            preds, scores = [], []
            for block in _blocks(batch.tolist()):
                languages, values = fitted.score([t or "" for t in block])
                preds += languages
                scores += values.tolist()
            yield pd.DataFrame({"lang_pred": preds, "score": np.array(scores, float)})

    scored = F.pandas_udf(run, schema).asNondeterministic()(F.col(text))
    worded = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return F.when(worded, scored).otherwise(F.struct(F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score")))


def predict(docs: DataFrame, model: KernelModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    predicted = docs.select(F.col(doc_id).alias("doc_id"), predictor(docs.sparkSession, model, text).alias("_p"))
    return predicted.select("doc_id", "_p.lang_pred", "_p.score")


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "")
        if size > BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of documents that no fit may use."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out, then predict all: doc_id, held_out, lang_pred, score."""
    model = train(docs, ~F.coalesce(held_out(), F.lit(False)))
    return predict(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


#: Below this score a text looks like none of the learned languages.
MIN_SCORE = 0.05


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose language is identified, with all columns; a null lang takes the prediction.

    Rejected are texts without a letter and texts that score below MIN_SCORE.
    """
    model = train(docs, ~F.coalesce(held_out(), F.lit(False)))
    judged = docs.withColumn("_predicted", predictor(docs.sparkSession, model))
    kept = judged.filter((F.col("_predicted.lang_pred") != UND) & (F.col("_predicted.score") >= MIN_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "_predicted.lang_pred")).select(*docs.columns)
