"""Exact, near and passage dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from crosstally.llm import digest_index, order_minhash, suffix_dedup


def sentence(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(words))


def edited(text, every, seed=0):
    words = text.split()
    for i in range(every // 2, len(words), every):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


AWKWARD = [
    (5, "same  text\n"),
    (3, "same text "),
    (4, None),
    (9, ""),
    (None, "same text "),
    (7, "same text "),
    (7, "same text "),
    (8, " "),
    (10, "z" * 300_000),
    (2, " ".join(["ha"] * 40_000)),
    (1, " ".join(["ha"] * 40_000)),
]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


class TestDigestIndex:
    def test_awkward_rows(self, spark, documents):
        found = digest_index.exact_dedup(documents(AWKWARD), digest_index.DigestIndex(spark, buckets=4)).collect()
        assert len(found) == len(AWKWARD)
        groups = {}
        for doc_id, text in AWKWARD:
            groups.setdefault(normal(text), []).append(doc_id)
        by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
        kept = {}
        for r in found:
            ids = by_hash[r["text_sha256"]]
            assert r["group_size"] == len(ids)
            assert r["keep_id"] == min(ids, key=lambda x: (x is not None, x))
            kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
        assert set(kept.values()) == {1}

    def test_empty(self, spark, documents):
        assert digest_index.exact_dedup(documents([]), digest_index.DigestIndex(spark, buckets=2)).count() == 0

    def test_index_persists(self, spark, documents):
        index = digest_index.DigestIndex(spark, buckets=4)
        assert digest_index.drop_copies(documents([(8, "a b"), (9, "c")]), index).count() == 2
        again = digest_index.DigestIndex(spark, index.name, buckets=4)
        later = digest_index.drop_copies(documents([(1, "a  b"), (2, "new"), (3, "new")]), again)
        assert [r["doc_id"] for r in later.collect()] == [2]
        assert again.read().count() == 3

    def test_repeated_rows_stay_once(self, spark, documents):
        rows = digest_index.drop_copies(documents(AWKWARD), digest_index.DigestIndex(spark, buckets=4))
        assert rows.columns[:3] == ["doc_id", "text", "lang"]
        assert sorted(r["text"] or "" for r in rows.collect()) == sorted(
            ["", "same text ", " ", "z" * 300_000, " ".join(["ha"] * 40_000)]
        )


def levenshtein(a, b):
    row = [*range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


class TestOrderMinHash:
    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), max_size=25), st.integers(0, 25))
    def test_banded_distance(self, a, b, band):
        exact = levenshtein(a, b)
        found = order_minhash.banded_distance(np.array(a, np.uint64), np.array(b, np.uint64), band)
        assert found == exact if exact <= band else found > band

    @settings(max_examples=100, deadline=None)
    @given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(0, 59), st.integers(0, 59))
    def test_similarity_never_exceeds_the_exact_one(self, a, drop, add):
        b = a[: drop % len(a)] + a[drop % len(a) + 1 :]
        b.insert(add % (len(b) + 1), 99)
        found = order_minhash.similarity(np.array(a, np.uint64), np.array(b, np.uint64))
        exact = 1 - levenshtein(a, b) / max(len(a), len(b))
        assert found <= exact + 1e-9
        if exact >= 0.95:
            assert found >= 0.8

    def test_word_hashes_follow_words(self):
        texts = [b"a bb  a", b"", b" \n", "é bb".encode(), b"a\tbb\x0ba "]
        one, two, three, four, five = order_minhash.word_hashes(texts)
        assert one[0] == one[2] != one[1] == four[1]
        assert len(two) == len(three) == 0
        assert (one == five).all()

    def test_classes(self, documents):
        base = [sentence(s, 120) for s in range(4)]
        rows = [(10 + i, b) for i, b in enumerate(base)]
        rows += [(20 + i, edited(b, 40, i)) for i, b in enumerate(base)]  # near
        rows += [(30 + i, b) for i, b in enumerate(base)]  # equal
        rows += [(40, base[0] + " " + base[1])]  # half of it is another
        hot = sentence(99, 150)
        rows += [(100 + i, edited(hot, 50, i)) for i in range(60)]
        rows += [(500, None), (501, ""), (502, " "), (503, "one two"), (504, "one  two"), (505, "one three")]
        rows += [(600, "w " * 30_000), (601, "w " * 30_000 + "v"), (None, sentence(77, 50)), (700, sentence(77, 50) + " x")]
        found = {r["doc_id"]: r for r in order_minhash.near_duplicates(documents(rows)).collect()}
        assert len(found) == len(rows)
        for i in range(4):
            assert {found[x + i]["class_id"] for x in (10, 20, 30)} == {10 + i}
            assert found[10 + i]["kept"] and not found[20 + i]["kept"] and not found[30 + i]["kept"]
        assert found[40]["class_id"] == 40
        assert {found[100 + i]["class_id"] for i in range(60)} == {100}
        assert found[501]["class_id"] == 500 and found[502]["class_id"] == 502
        assert found[504]["class_id"] == 503 and found[505]["class_id"] == 505
        assert found[601]["class_id"] == 600
        assert found[None]["class_id"] is None and found[700]["class_id"] is None and found[None]["kept"]

    def test_empty(self, documents):
        assert order_minhash.near_duplicates(documents([])).count() == 0

    @pytest.mark.parametrize("chunk", [3, 8, 1000])
    def test_chunks_lose_no_group(self, spark, chunk):
        """One bucket with a dense group, and many texts that are near nothing; whatever the chunks."""
        rng = np.random.default_rng(2)
        dense = rng.integers(0, 1 << 16, order_minhash.TABLES).astype("<u2")
        rows = []
        for i in range(40):
            own = dense.copy()
            own[rng.integers(0, order_minhash.TABLES, 8)] = i
            rows.append((7, i, 80, own.tobytes()))
        rows += [(7, 100 + i, 80, rng.integers(0, 1 << 16, order_minhash.TABLES).astype("<u2").tobytes()) for i in range(38)]
        twin = rng.integers(0, 1 << 16, order_minhash.TABLES).astype("<u2")
        twins = [twin.copy(), twin.copy()]
        twins[1][4:] = 1 << 15  # agree in four tables
        rows += [(7, 200 + i, 80, t.tobytes()) for i, t in enumerate(twins)]
        frame = spark.createDataFrame(rows, "bucket long, id long, n long, signature binary")
        pairs = {tuple(r) for r in order_minhash.candidate_pairs(frame, chunk).collect()}
        signature = {r[1]: np.frombuffer(r[3], "<u2") for r in rows}
        assert all(a < b and (signature[a] == signature[b]).sum() >= order_minhash.AGREE for a, b in pairs)
        assert (200, 201) in pairs
        links = spark.createDataFrame(sorted(pairs), "a long, b long")
        classes = {r["id"]: r["class_id"] for r in order_minhash.components(links).collect()}
        assert {classes[i] for i in range(40)} == {0} and classes[201] == 200

    def test_groups_reach_over_batches(self):
        import pandas as pd

        rows = pd.DataFrame({"k": [1, 1, 2, 2, 2, 3, 4, 4], "v": range(8)})
        for size in (1, 2, 3, 8):
            batches = [rows.iloc[i : i + size] for i in range(0, 8, size)]
            found = [g["v"].tolist() for g in order_minhash._groups(iter([*batches, rows.iloc[:0]]), ["k"])]
            assert found == [[0, 1], [2, 3, 4], [5], [6, 7]]

    def test_large_buckets_come_apart(self, documents):
        """Texts that share a long passage fill buckets but are no near duplicates."""
        passage = sentence(5, 60)
        rows = [(i, passage + " " + sentence(1000 + i, 60)) for i in range(40)]
        rows += [(100 + i, passage + " " + edited(sentence(1000 + i, 60), 30, i)) for i in range(40)]
        found = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(documents(rows)).collect()}
        assert all(found[i] == i and found[100 + i] == i for i in range(40))

    @pytest.mark.parametrize("chunk", [8192, 5])
    def test_cells_send_fewer_links_than_classes(self, spark, chunk):
        """Texts of like make-up that share a passage; some are near, each cell joins its classes once."""
        om, rng = order_minhash, random.Random(chunk)
        passage = sentence(5, 80)
        texts = []
        for i in range(30):
            words = sentence(77, 80).split()
            rng.shuffle(words)
            texts += [passage + " " + " ".join(words)] + [passage + " " + edited(" ".join(words), 9, i + v) for v in range(i % 3)]
        rows = spark.createDataFrame([(i, t.encode(), t.encode()) for i, t in enumerate(texts)], "id long, text_hash binary, text binary")
        bucket_rows = om.candidate_rows(om.sketch_texts(rows))
        found = [(r["a"], r["b"]) for r in om.cell_links(bucket_rows, rows.select("id", "text"), chunk).collect()]
        words = [t.split() for t in texts]
        near = {
            (a, b)
            for a in range(len(texts))
            for b in range(a + 1, len(texts))
            if levenshtein(words[a], words[b]) <= 0.2 * max(len(words[a]), len(words[b]))
        }
        assert near and set(found) <= near

        def classes(links):
            top = list(range(len(texts)))
            for _ in texts:
                for a, b in links:
                    top[a] = top[b] = min(top[a], top[b])
            return top

        assert classes(found) == classes(near)
        if chunk > len(texts):
            assert len(found) <= om.SEEN * om.TABLES * len(texts)

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.integers(0, 3), min_size=2, max_size=25), st.lists(st.integers(0, 3), min_size=2, max_size=25))
    def test_an_edit_takes_two_runs_at_most(self, one, two):
        om = order_minhash
        a, b = (om.word_hashes([" ".join(f"w{x}" for x in t).encode()])[0] for t in (one, two))
        numbers, begin, count = om.shared_grams([a, b])
        own, other = (set(numbers[begin[i] : begin[i] + count[i]].tolist()) for i in (0, 1))
        assert len(own) == len(one) - 1 and len(other) == len(two) - 1
        assert max(len(one), len(two)) - 1 - len(own & other) <= 2 * levenshtein(one, two)

    def test_copies_follow_few_leaders(self, spark):
        """Every copy of a group is compared with a few others in the first pass, not with one a table."""
        om, rng, base = order_minhash, random.Random(8), sentence(70, 150).split()
        texts = []
        for i in range(300):
            words = list(base)
            for at in rng.sample(range(150), 6):
                words[at] = f"own{i}x{at}"
            texts.append(" ".join(words).encode())
        rows = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "id long, text_hash binary, text binary")
        bucket_rows = om.candidate_rows(om.sketch_texts(rows))
        pairs = om.close_pairs(bucket_rows)
        assert pairs.count() < 12 * 300
        links = om.verify(pairs, rows.select("id", "text")).filter("similarity > 0")
        classes = [r["class_id"] for r in om.components(links).collect()]
        assert len(classes) > 290 and classes.count(0) > 290

    def test_more_linked_extends_classes(self, spark):
        om, rng = order_minhash, random.Random(4)
        links = [tuple(sorted(rng.sample(range(80), 2))) for _ in range(60)]
        first, later = (spark.createDataFrame(x, "a long, b long") for x in (links[:30], links[30:]))
        extended = {tuple(r) for r in om.more_linked(om.components(first), later).collect()}
        assert extended == {tuple(r) for r in om.components(first.union(later)).collect()}
        known = om.components(first)
        assert {tuple(r) for r in om.more_linked(known, first).collect()} == {tuple(r) for r in known.collect()}

    @settings(max_examples=100, deadline=None)
    @given(
        st.lists(st.integers(0, 5), min_size=1, max_size=40),
        st.lists(st.integers(0, 5), min_size=1, max_size=40),
        st.integers(0, 20),
    )
    def test_distance_within_a_band(self, one, two, band):
        om = order_minhash
        a, b = (om.word_hashes([" ".join(f"w{x}" for x in t).encode()])[0] for t in (one, two))
        assert min(om.banded_distance(a, b, band), band + 1) == min(levenshtein(one, two), band + 1)

    def test_grams_of_a_cell_give_the_similarity_of_each_pair(self):
        om, rng = order_minhash, random.Random(6)
        texts = [[rng.choice("abcdef") for _ in range(rng.randint(5, 40))] for _ in range(30)]
        texts += [t[: len(t) // 2] + ["new"] + t[len(t) // 2 :] for t in texts]
        words = om.word_hashes([" ".join(t).encode() for t in texts])
        single, longer = om.Grams(words, 1), om.Grams(words, om.K)
        others = np.arange(len(texts))
        for i, text in enumerate(texts):
            shared = single.shared(i, others)[0].tolist()
            assert shared == [sum(min(text.count(w), t.count(w)) for w in set(text)) for t in texts]
            for j in others.tolist():
                places = longer.shared(i, np.array([j]))[1:]
                assert om.along_shared(words[i], words[j], om.K, *places) == om.similarity(words[i], words[j])

    def test_star_family_is_one_class(self, documents):
        """Variants near a base that are not near each other, many enough to fill its buckets."""
        rng = random.Random(3)
        base = [sentence(2000 + i, 10) for i in range(100)]
        rows = [(1000, " ".join(base))]
        for v in range(80):
            own = set(rng.sample(range(100), 15))
            rows.append((v, " ".join(sentence(10_000 + 100 * v + i, 10) if i in own else x for i, x in enumerate(base))))
        found = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(documents(rows)).collect()}
        assert set(found.values()) == {0}

    @pytest.mark.parametrize("words, least", [(5, 1.0), (8, 1.0), (14, 1.0), (20, 0.95), (60, 0.95), (300, 0.97)])
    def test_finds_pairs_by_edit_similarity(self, documents, words, least):
        """Pairs with scattered edits, held against brute-force alignment."""
        rng = random.Random(words)
        rows, near = [], set()
        for i in range(120):
            text = sentence(30_000 + 1000 * words + i, words).split()
            other = list(text)
            for at in rng.sample(range(words), max(1, int(words * rng.choice([0.05, 0.1, 0.15, 0.2])))):
                other[at] = rng.choice([f"edit{at}", ""])
            other = " ".join(other).split()
            rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
            if levenshtein(text, other) <= 0.2 * max(len(text), len(other)):
                near.add(i)
        found = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(documents(rows)).collect()}
        linked = {i for i in range(120) if found[2 * i + 1] == found[2 * i]}
        assert linked <= near and len(near) > 100
        assert len(linked) >= least * len(near)


def brute_repeats(rows):
    """The contract, passage by passage."""
    out, seen = {}, set()
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        mark = bytearray(len(data))
        own = [data[p : p + 50] for p in range(len(data) - 49)]
        for p, passage in enumerate(own):
            if passage in seen:
                mark[p : p + 50] = b"\1" * 50
        seen.update(own)
        kept = bytes(x for x, m in zip(data, mark) if not m)
        spans = sum(1 for p, m in enumerate(mark) if m and not (p and mark[p - 1]))
        out[doc_id] = (len(data), sum(mark), spans, hashlib.sha256(kept).hexdigest())
    return out


class TestSuffixDedup:
    @pytest.mark.parametrize("hot", [1000, 1])
    def test_brute_force(self, documents, hot):
        rng = random.Random(3)
        shared = [sentence(s, 30) for s in range(6)]
        rows = []
        for i in range(60):
            parts = [sentence(100 + i, rng.randint(0, 20)), rng.choice(shared), sentence(200 + i, 5)]
            rows.append((i * 3, " ".join(parts) + rng.choice(["", "!" * 80, "ab" * 60, "é" * 40, "\0" * 70])))
        rows += [(1000, shared[0][:50]), (1001, shared[0][:49]), (1002, None), (1003, ""), (1004, "!" * 500)]
        rows += [(1005, rows[0][1]), (None, shared[1]), (1006, "ab" * 40_000), (1007, "ab" * 39_000 + "c")]
        rng.shuffle(rows)
        cut = suffix_dedup.remove_repeats(documents(rows), hot=hot).collect()
        found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in cut}
        assert found == brute_repeats(rows)
        texts = dict(rows)
        for r in cut:
            data = (texts[r["doc_id"]] or "").encode()
            assert sum(b - a for a, b in zip(r["span_from"], r["span_to"])) == r["n_removed"] <= len(data)

    def test_chance_repeats_do_not_travel(self):
        """Texts that share words and tokens, but no passage, send no contexts; a shared passage sends its own."""
        rng = random.Random(8)
        middle = b"a token of twenty-four b"
        noise = [bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(400)]
        one, two = ([x + middle + y for x, y in zip(n[::2], n[1::2])] for n in (noise[:200], noise[200:]))
        cuts = np.array([], "S16")
        batches = [suffix_dedup.Batch(texts, cuts) for texts in (one, two, [one[7]])]

        def sent(*chosen):
            keys = np.concatenate([b.keys for b in chosen])
            kinds = suffix_dedup._classes(keys, np.concatenate([b.more for b in chosen]), 1000)
            parts = np.split(kinds, np.cumsum([len(b.keys) for b in chosen])[:-1])
            return [suffix_dedup.Contexts(b, k, 1, local=False).texts for b, k in zip(chosen, parts)]

        assert sent(batches[0], batches[1]) == [[], []]
        for texts in sent(batches[0], batches[2]):
            held = {t[i : i + 50] for t in texts for i in range(len(t) - 49)}
            assert {one[7][i : i + 50] for i in range(len(one[7]) - 49)} <= held

    def test_keys_of_one_batch_are_settled_there(self):
        """What several documents of one batch only hold is no answer of a bucket."""
        text = sentence(21, 60).encode()
        batch = suffix_dedup.Batch([text, text[:150], sentence(22, 60).encode()], np.array([], "S16"))
        alone = np.full(len(batch.keys), suffix_dedup.ALONE, np.uint8)
        assert suffix_dedup.Contexts(batch, alone, 4, local=False).texts == []
        found = suffix_dedup.Contexts(batch, alone, 4, local=True)
        assert {*found.bucket} == {8}
        held = {t[i : i + 50] for t in found.texts for i in range(len(t) - 49)}
        assert {text[i : i + 50] for i in range(101)} <= held

    def test_copies_share_a_batch(self, documents):
        """Copies and near copies meet in one batch, unless they are more than a batch holds; short and null texts have one too."""
        rows = []
        for i in range(40):
            text = sentence(500 + i, 80)
            rows += [(i, text), (100 + i, text), (200 + i, text + " end"), (300 + i, text[:40]), (400 + i, None)]
        plain = documents(rows).selectExpr("doc_id AS id", "cast(coalesce(text, '') AS binary) AS text")
        of = {r["id"]: r["batch"] for r in suffix_dedup.dealt_alike(plain, 16, 1 << 20).collect()}
        assert len(of) == len(rows) and {*of.values()} <= {*range(16)}
        assert all(of[i] == of[100 + i] for i in range(40))
        assert sum(of[i] == of[200 + i] for i in range(40)) >= 36
        copies = documents([(i, sentence(500, 80)) for i in range(64)])
        plain = copies.selectExpr("doc_id AS id", "cast(text AS binary) AS text")
        assert len({r["batch"] for r in suffix_dedup.dealt_alike(plain, 64, 2000).collect()}) > 8

    def test_least_tokens(self):
        """One hash for each text of a passage or more, whatever is worked on with it."""
        rng = random.Random(2)
        texts = [rng.randbytes(rng.choice([0, 7, 49, 50, 51, 300, 40_000])) for _ in range(80)] + [b"x" * 20]
        found = suffix_dedup.least_tokens(texts)
        assert [x is None for x in found] == [len(t) < 50 for t in texts]
        assert found == [suffix_dedup.least_tokens([t])[0] for t in texts]

    @pytest.mark.parametrize("ahead, count", [(34, 35), (17, 18), (34, 17), (20, 9), (0, 1), (6, 7), (7, 2)])
    def test_steps(self, ahead, count):
        cut = [*suffix_dedup._steps(ahead, count)]
        assert [p for a, b in cut for p in range(a, b)] == [*range(count)]
        assert all((ahead - a) // 7 == (ahead - b + 1) // 7 for a, b in cut)
        assert len({(ahead - a) // 7 for a, _ in cut}) == len(cut)

    def test_messages(self):
        numbers = np.array([0, 5, -(1 << 63), 1 << 40], np.int64)
        assert suffix_dedup.from_planes(suffix_dedup.planes(numbers)).tolist() == numbers.tolist()
        for data in (b"", b"ab", b"ab" * 500):
            assert suffix_dedup.unpacked(suffix_dedup.packed(data), len(data)) == data
        assert len(suffix_dedup.packed(b"ab" * 500)) < 100

    @pytest.mark.parametrize("hot", [1000, 2, 0])
    def test_many_batches(self, documents, monkeypatch, hot):
        """Passages that meet over many batches and buckets, some in many surroundings."""
        monkeypatch.setattr(suffix_dedup, "LEAST_BATCH", 1 << 11)
        monkeypatch.setattr(suffix_dedup, "LEAST_BUCKET", 1 << 12)
        rng = random.Random(14)
        parts = [sentence(900 + s, 12) for s in range(12)]
        rows = [(i, " ".join(rng.choices(parts, k=3) + [sentence(1000 + i, 6)] + rng.choices(parts, k=2))) for i in range(90)]
        rows += [(200 + i, rows[3 * i][1][i:]) for i in range(20)] + [(300 + i, rows[5][1]) for i in range(20)]
        rng.shuffle(rows)
        cut = suffix_dedup.remove_repeats(documents(rows), hot=hot).collect()
        found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in cut}
        assert found == brute_repeats(rows)

    def test_rows_of_one_id_keep_their_bytes(self, documents):
        text = sentence(1, 40)
        cut = suffix_dedup.remove_repeats(documents([(1, text), (1, text), (2, text)])).collect()
        assert sorted((r["doc_id"], r["n_removed"]) for r in cut) == [(1, 0), (1, 0), (2, len(text))]

    def test_empty(self, documents):
        assert suffix_dedup.remove_repeats(documents([])).count() == 0

    def test_long_texts_are_cut_into_pieces(self, monkeypatch):
        monkeypatch.setattr(suffix_dedup, "PIECE", 100)
        data = sentence(4, 300).encode()
        for block in suffix_dedup.blocks([data, b"short", data]):
            for begin, count, doc, offset in zip(block.begin, block.count, block.doc, block.offset):
                assert doc in (0, 2)
                assert block.data[begin : begin + count + 49] == data[offset : offset + count + 49]

    def test_small_blocks_of_texts(self):
        """Texts are worked on a few at a time, with the same groups of passages."""
        texts = [sentence(i, 300).encode() for i in range(200)]
        found = [*suffix_dedup.blocks(texts)]
        longest = max(map(len, texts))
        assert all(len(b.data) < suffix_dedup.BLOCK + longest for b in found)
        alone = [(i, b) for i, t in enumerate(texts) for b in suffix_dedup.blocks([t])]
        for name in ("offset", "count", "key", "head"):
            together, apart = (np.concatenate([getattr(b, name) for b in x]) for x in (found, [b for _, b in alone]))
            assert (together == apart).all()
        assert np.concatenate([b.doc for b in found]).tolist() == [i for i, b in alone for _ in b.key]

    def test_smaller_holders(self):
        rng = random.Random(9)
        parts = ["".join(rng.choices("abc", k=30)) for _ in range(6)]
        texts = ["".join(rng.choices(parts, k=rng.randint(2, 4))).encode() for _ in range(60)]
        docs = np.array([rng.randint(0, 30) for _ in texts])
        found, counts = suffix_dedup.smaller_holders(texts, docs)
        assert counts.tolist() == [len(t) - 49 for t in texts]
        smallest = {}
        passages = [(t[i : i + 50], d) for t, d in zip(texts, docs.tolist()) for i in range(len(t) - 49)]
        for passage, doc in passages:
            smallest[passage] = min(doc, smallest.get(passage, doc))
        assert found.tolist() == [smallest[passage] < doc for passage, doc in passages]

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 2), st.integers(0, 1)), min_size=1, max_size=40))
    def test_multikey_runs(self, rows):
        words = np.array(rows, np.uint64)
        order, first = suffix_dedup.multikey_runs(words)
        ordered = [rows[i] for i in order]
        assert ordered == sorted(rows)
        assert [ordered[i] for i in first] == sorted(set(rows))
