"""Ids that repeat or are null: nothing is lost and nothing multiplied."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from crosstally.llm import digest_index as di, mixing as mx, order_minhash as om, topk


def text(seed, words=120):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(5000)}" for _ in range(words))


def changed(whole, seed, share=0.05):
    draw, words = random.Random(seed), whole.split()
    for i in draw.sample(range(len(words)), int(share * len(words))):
        words[i] = f"x{draw.randrange(10**6)}"
    return " ".join(words)


def test_a_text_is_not_lost_to_another_of_its_id(documents):
    a, b = text(1), text(2)
    rows = om.near_duplicates(documents([(3, changed(a, 5)), (7, a), (7, b)])).collect()
    found = Counter((r["doc_id"], r["class_id"], r["kept"]) for r in rows)
    assert found == Counter([(3, 3, True), (7, 3, False), (7, 7, True)])


def test_many_null_ids_stay_linear(documents):
    rows = [(None, text(i, 60)) for i in range(120)] + [(None, changed(text(0, 60), 9)), (5, changed(text(1, 60), 9))]
    found = om.near_duplicates(documents(rows)).collect()
    assert len(found) == len(rows) and sum(r["kept"] for r in found) == 120
    assert om.drop_near_duplicates(documents(rows)).count() == 120


def test_mix_equals_what_is_taken(documents):
    rows = [(None, text(i, 5 + i % 7), "en", f"s{i % 4}") for i in range(400)]
    rows += [(9, "same five words each time", "en", "s1")] * 60 + [(9, "same five words each time", "fr", "s2")] * 5
    rows += [(10, None, "en", None), (11, "", "en", "s3")]
    docs = documents(rows)
    taken = mx.taken(docs).groupBy("doc_id", "source_size").agg(F.sum("taken").alias("n")).collect()
    mixed = mx.mixed_rows(docs)
    assert mixed.columns == docs.columns
    sizes = {(r["source"]): r["n"] for r in docs.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    drawn = Counter()
    for r in mixed.collect():
        drawn[r["doc_id"]] += len(r["text"].split())
    expected = Counter()
    for r in taken:
        expected[r["doc_id"]] += r["n"]
    assert +drawn == +expected and sizes
    again = Counter(tuple(r) for r in mx.mixed_rows(docs).collect())
    assert again == Counter(tuple(r) for r in mixed.collect())


def test_each_source_comes_near_its_target(spark):
    from crosstally.llm.common import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    plan = {r["source"]: r["target"] for r in mx.draws(docs).select("source", "target").distinct().collect()}
    words = Counter()
    for r in mx.mixed_rows(docs).select("source", "text").collect():
        words[r["source"]] += len(r["text"].split())
    longest = docs.agg(F.max(F.size(F.split("text", " ")))).first()[0]
    assert all(abs(words[s] - t) <= 3 * longest + 0.01 * t for s, t in plan.items())


def test_extreme_ids_do_not_overflow(spark, documents):
    low, high = -(1 << 63), (1 << 63) - 1
    docs = documents([(low, "a"), (high, "a"), (high, "b"), (None, "b"), (None, "b")])
    found = di.exact_dedup(docs, di.DigestIndex(spark)).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["kept"]) for r in found) == Counter(
        [(low, low, True), (high, low, False), (high, None, False), (None, None, True), (None, None, False)]
    )
    kept = di.drop_copies(docs, di.DigestIndex(spark)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(low, "a"), (None, "b")])


def test_weights_at_the_edge_of_their_type(spark):
    df = spark.createDataFrame([(1, [0.5, -0.5]), (50, [0.5, 0.5]), (3, [-0.5, 0.25])], "vec_id long, embedding array<double>")
    vectors = topk.quantised(df)
    found = topk.top_k(vectors.filter("vec_id = 50"), vectors, 5).collect()
    x = {1: np.array([128, -128]), 3: np.array([-128, 64])}
    q = np.array([128, 128])
    assert {(r["vec_id"], r["score"]) for r in found} == {(i, int(v @ q)) for i, v in x.items()}


def test_word_bins_never_ask_for_more_edits_than_there_are():
    rng = np.random.default_rng(4)
    for _ in range(60):
        words = rng.integers(0, 1 << 63, int(rng.integers(1, 900))).astype(np.uint64)
        edits = int(rng.integers(0, max(1, len(words) // 2)))
        other = words.copy()
        for _ in range(edits):
            kind, at = rng.integers(0, 3), int(rng.integers(0, max(1, len(other))))
            if kind == 0 and len(other):
                other[at] = rng.integers(0, 1 << 63)
            elif kind == 1:
                other = np.insert(other, at, words[0])
            elif len(other) > 1:
                other = np.delete(other, at)
        bound = om.least_edits(om.word_bins(words), [om.word_bins(other), om.word_bins(words)])
        assert bound[0] <= edits and bound[1] == 0
