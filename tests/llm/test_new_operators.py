"""Phrase mining, vector codes and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from crosstally.llm import cover_codes as cc, decontaminate as dc, phrases as ph
from crosstally.llm.common import table

SF = "/root/testdata/sf0.001"


# -- phrases ---------------------------------------------------------------------------


def mined(rows, min_count, top=2000):
    """The contract on (lang, text) rows, with Python's whole numbers."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                   for q, b in candidates.items()):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("share", [0.02, 0.5])
def test_phrases_equal_brute_force(spark, documents, share):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["é", "ñandú", "A", "\x0e", "İ"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(150):
        text = "".join(w + draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", ";"]) for w in draw.choices(words, weights, k=40))
        rows.append((i, text, draw.choice(["en", None, "und", "x\ny"])))
    rows += [(200 + i, "only these two", "rare") for i in range(9)] + [(300, None, "en"), (301, "", "fr"), (301, " .", "fr")]
    found = collected(ph.collocations(documents(rows), min_count=10, share=share))
    assert found == mined([(r[2], r[1]) for r in rows], 10)
    assert not any(r[0] == "rare" for r in found)


def test_phrases_across_windows_and_slices(spark, documents, monkeypatch):
    text = " ".join(f"a{i % 7} b{i % 3}" for i in range(3000)) + "." + "z" * 5000 + " " + "end stop " * 30
    monkeypatch.setattr(ph, "window_bytes", lambda longest: 1 << 10)
    counters = []
    for part in ph._slices(text.encode().translate(ph._PLAIN), 128):
        counters.append(part)
    assert b"".join(counters) == text.encode()
    found = collected(ph.collocations(documents([(1, text, "en"), (2, text, "en")])))
    assert found == mined([("en", text)] * 2, 10)


def test_phrases_of_an_empty_table(spark, documents):
    assert collected(ph.collocations(documents([]))) == []
    assert collected(ph.collocations(documents([(1, None, None), (2, "a b", None)]))) == []


def test_what_the_sample_misses_is_counted_in_a_further_pass(spark, documents, monkeypatch):
    passes = []
    whole = ph._pass
    monkeypatch.setattr(ph, "_pass", lambda docs, longest, now, before: passes.append(len(before)) or whole(docs, longest, now, before))
    rows = [(i, f"common words here {i}", "en") for i in range(40)]
    found = collected(ph.collocations(documents(rows), share=0.0))
    assert found == mined([(r[2], r[1]) for r in rows], 10) and found
    assert passes == [0, 0, 1, 2]  # the sample, then three passes until no failure is left


# -- vector codes ----------------------------------------------------------------------


def lloyd(rows, width, parts=16, entries=64, rounds=2):
    """(codes by position, errors, codebooks) of (id, label, integers) rows, plainly."""
    x = np.zeros((len(rows), width), np.int64)
    for i, (_, _, terms) in enumerate(rows):
        x[i, : len(terms)] = terms
    x = x.reshape(len(rows), parts, width // parts)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2]))
    books = [x[order[:entries], p].copy() for p in range(parts)]
    for step in range(rounds + 1):
        codes, error = [], 0
        for p in range(parts):
            gaps = ((x[:, p, None] - books[p][None]) ** 2).sum(2)
            near = gaps.argmin(1)
            codes.append(near)
            error = error + gaps.min(1)
            if step < rounds:
                for e in set(near.tolist()):
                    books[p][e] = x[near == e, p].sum(0) // (near == e).sum()
    return np.stack(codes, 1), error, np.stack(books)


def test_cover_tree_assigns_as_brute_force_does():
    rng = np.random.default_rng(5)
    tight = rng.integers(-5000, 5000, (40, 6))[rng.integers(0, 40, 4000)] + rng.integers(-3, 4, (4000, 6))
    equal = np.repeat(rng.integers(-9, 9, (3, 6)), 500, 0)
    for points, entries in (
        (tight, rng.integers(-5000, 5000, (30, 6))),
        (rng.integers(-3, 3, (3000, 6)), rng.integers(-3, 3, (64, 6))),  # many ties
        (equal, equal[:1]),
        (np.zeros((0, 6), np.int64), equal[:2]),
    ):
        tree = cc.Tree.unpack(cc.build_tree(points).pack())
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        inside = points[tree.order]
        found = cc.assign(tree, inside, entries)
        near = ((inside[:, None] - entries[None]) ** 2).sum(2).argmin(1)
        assert (found.labels == near).all()
        for e in range(len(entries)):
            assert found.counts[e] == (near == e).sum()
            assert (found.sums[e] == inside[near == e].sum(0)).all()
    tree = cc.build_tree(tight)
    assert cc.assign(tree, tight[tree.order], rng.integers(-5000, 5000, (30, 6))).compared < len(tight) / 2


def test_radius_covers_all_points_of_a_node():
    points = np.random.default_rng(1).integers(-100, 100, (2000, 4))
    tree = cc.build_tree(points)
    inside = points[tree.order]
    for (start, end, routing, child, last), radius in zip(tree.nodes, tree.radius):
        assert np.sqrt(((inside[start:end] - inside[routing]) ** 2).sum(1)).max() <= radius + 1e-9
        if last:
            assert tree.nodes[child, 0] == start and tree.nodes[last - 1, 1] == end


def test_codes_equal_plain_lloyd(spark):
    rng = np.random.default_rng(2)
    made = [(int(i), None if i % 9 == 0 else int(i % 4), rng.normal(0, 0.1, 32).tolist(), "x", 1) for i in rng.permutation(300)]
    made += [(7, 1, made[0][2], "x", 1), (None, 2, made[1][2], "x", 1), (400, 1, [0.5] * 3, "x", 1), (401, None, [], "x", 1)]
    bad = [(1000, 1, None, "x", 1), (1001, 1, [0.1, None], "x", 1), (1002, 1, [float("nan")], "x", 1), (1003, 1, [float("inf")], "x", 1)]
    df = spark.createDataFrame(made + bad, "vec_id long, label int, embedding array<double>, code string, error int").repartition(3)
    done = cc.compress(df)
    rows = [(i, label, [int(np.floor(256 * v)) for v in vector]) for i, label, vector, _, _ in made]
    codes, error, books = lloyd(rows, 32)
    assert (done.codebooks == books).all()
    expected = Counter((r[0], r[1], tuple(c), int(e)) for r, c, e in zip(rows, codes.tolist(), error))
    found = cc.with_label_errors(done.codes).withColumn("hex", cc.hex_code("code")).collect()
    assert Counter((r["vec_id"], r["label"], tuple(r["code"]), r["error"]) for r in found) == expected
    by_label = Counter()
    for r, e in zip(rows, error):
        by_label[r[1]] += int(e)
    assert all(r["label_error"] == by_label[r["label"]] for r in found)
    assert all(r["hex"] == "".join(f"{c:02x}" for c in r["code"]) for r in found)
    text = ",".join(str(v) for part in books for entry in part for v in entry)
    assert done.codebooks_sha256() == hashlib.sha256(text.encode()).hexdigest()


def test_codes_of_few_or_no_vectors(spark):
    shape = "vec_id long, label int, embedding array<float>"
    assert cc.compress(spark.createDataFrame([], shape)).codes.count() == 0
    assert cc.compress(spark.createDataFrame([(1, 1, None)], shape)).codes.count() == 0
    one = cc.with_label_errors(cc.compress(spark.createDataFrame([(1, None, [1.0, -0.001])] * 3, shape)).codes).collect()
    assert [(r["error"], r["label_error"], r["code"]) for r in one] == [(0, 0, [0] * 16)] * 3
    with pytest.raises(Exception, match="too large"):
        cc.compress(spark.createDataFrame([(1, 1, [1e30, 0.0]), (2, 1, [0.0, 1e15])], shape)).codes.count()


# -- decontamination -------------------------------------------------------------------


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def hit(docs, items, window=10):
    """Per document: hit words, item ids, stretches of the text."""
    windows = defaultdict(set)
    for item, text in items:
        words = [w for w, _, _ in words_of(text)]
        if words:
            for i in range(max(1, len(words) - window + 1)):
                windows[tuple(words[i : i + window])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        found = words_of(text)
        words, marked, ids = [w for w, _, _ in found], set(), set()
        for k in sizes:
            for i in range(len(words) - k + 1):
                if (key := tuple(words[i : i + k])) in windows:
                    marked |= set(range(i, i + k))
                    ids |= windows[key]
        starts = [i for i in sorted(marked) if i - 1 not in marked]
        ends = [i for i in sorted(marked) if i + 1 not in marked]
        spans = tuple((a, b + 1, found[a][1], found[b][2]) for a, b in zip(starts, ends))
        out.append((doc_id, len(words), len(marked), tuple(sorted(ids)), spans))
    return Counter(out)


@pytest.mark.parametrize("shard_words", [dc.SHARD_WORDS, 40])
def test_hits_equal_brute_force(spark, documents, shard_words, monkeypatch):
    draw = random.Random(9)
    vocabulary = ["the", "Of", "ñandú", "x1", "É", "é", "word", "zebra", "q" * 80, "q" * 79, "日本"]
    marks = [" ", ", ", "--", "\x00", "\n", "  ", "\x7f", "🙂 "]

    def text(n):
        return "".join(draw.choice(vocabulary) + draw.choice(marks) for _ in range(n))

    items = [(i, text(draw.choice([1, 3, 9, 10, 11, 30]))) for i in range(12)]
    items += [(3, text(12)), (None, text(15)), (50, None), (51, " .,"), (60, items[4][1]), (4, items[4][1])]
    docs = [(i, text(40) + draw.choice(items)[1:][0] + text(20) if i % 3 else text(60)) for i in range(30) if i != 3]
    docs = [(i, t) for i, t in docs if t] + [(90, None), (91, ""), (92, items[0][1]), (5, "!"), (5, text(30)), (5, text(30))]
    docs += [(None, items[9][1] or "x")] * 3 + [(93, ("pad " * 30_000) + (items[5][1] or ""))]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = dc.decontaminate(documents(docs), dc_table(benchmark), 10) if shard_words == dc.SHARD_WORDS else None
    spans = dc.find_windows(documents(docs), benchmark, shard_words=shard_words).collect()
    rows = Counter(
        (r["doc_id"], r["n_words"], sum(s["word_end"] - s["word"] for s in r["spans"]), tuple(r["items"]),
         tuple((s["word"], s["word_end"], s["start"], s["end"]) for s in r["spans"]))
        for r in spans
    )
    assert rows == hit(docs, items)
    if found is not None:
        assert Counter((r["doc_id"], r["n_hit"], r["contaminated"]) for r in found.collect()) == Counter(
            (r[0], r[2], bool(r[4])) for r in hit(docs, items).elements()
        )


def dc_table(benchmark):
    return benchmark.repartition(2)


def test_no_benchmark_no_hits(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = dc.decontaminate(documents([(1, "some words"), (2, None)]), none).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in rows) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert dc.decontaminate(documents([]), none).count() == 0


def test_given_benchmark_over_several_automata(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    one, many = dc.find_windows(docs, items), dc.find_windows(docs, items, shard_words=300)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
