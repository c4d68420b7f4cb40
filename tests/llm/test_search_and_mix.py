"""Top-k search, source mixing, language identification and tool calls against brute force."""

from __future__ import annotations

import json
import math
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from crosstally.llm import language, mixing, tool_calls, topk

NAN, INF = float("nan"), float("inf")


class TestTopK:
    def rows(self):
        rng = random.Random(1)
        rows = [(i, [rng.randint(-3, 3) / 4 for _ in range(6)]) for i in range(120)]
        rows += [(200 + i, rows[0][1]) for i in range(30)]  # ties
        rows += [(300, None), (301, []), (302, [NAN, 1.0]), (303, [INF, 1.0]), (304, [None, 1.0]), (None, [1.0])]
        return rows + [(305, [2.0]), (306, [0.0] * 6), (50, [9.0] * 6), (307, [-(2.0**40)] * 6)]

    def brute(self, rows, step, k):
        usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(
            x is not None and math.isfinite(x) for x in v
        )]
        out = set()
        for q, a in usable:
            if q % step == 0:
                scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q]
                out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)}
        return out

    def test_brute_force(self, spark):
        rows = self.rows()
        rows = [r for r in rows if r != (50, [9.0] * 6)]
        frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, rank int, score int")
        vectors = topk.quantised(frame)
        found = topk.top_k(vectors.filter("vec_id % 50 = 0"), vectors, 5)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert {tuple(r) for r in found.collect()} == self.brute(rows, 50, 5)

    def test_fewer_than_k_and_empty(self, spark):
        vectors = topk.quantised(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>"))
        assert [tuple(r) for r in topk.top_k(vectors.filter("vec_id = 0"), vectors, 5).collect()] == [(0, 1, 1, 131072)]
        none = vectors.filter("vec_id > 5")
        assert topk.top_k(none, vectors, 5).count() == 0
        assert topk.top_k(vectors, none, 5).count() == 0

    def test_sparse_terms(self):
        q = np.array([[0, 2, 0], [1, 0, 0]])
        c = np.array([[5, 0, 7], [0, 3, 0], [1, 1, 1]])
        assert (topk.score_block(q, c) == q @ c.T).all()


class TestMixing:
    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(0, 1000), max_size=12))
    def test_targets(self, sizes):
        weights = mixing.cycling_weights(sizes)
        targets = mixing.capped_targets(sizes, weights, 3)
        assert sum(targets) == sum(sizes)
        free = [Fraction(t) / w for t, s, w in zip(targets, sizes, weights) if t < 3 * s]
        assert len(set(free)) <= 1  # those below their cap share by weight
        for t, s, w in zip(targets, sizes, weights):
            assert t <= 3 * s and (t < 3 * s or not free or t <= free[0] * w)

    @settings(max_examples=100, deadline=None)
    @given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(1, 9), st.integers(0, 99))
    def test_tree_deals_out_exact_quotas(self, quotas, shards, seed):
        dealt = mixing.splitting_tree(quotas, shards, seed)
        assert (dealt >= 0).all() and dealt.sum(0).tolist() == quotas
        per_shard = dealt.sum(1)
        assert per_shard.max() - per_shard.min() <= math.ceil(math.log2(shards)) + 1
        assert (dealt == mixing.splitting_tree(quotas, shards, seed)).all()

    def rows(self):
        rows = [(i, "w " * (10 + i % 7), "en", f"s{i % 5}") for i in range(400)]
        rows += [(1000 + i, "w " * 40, "en", "tiny") for i in range(2)]
        return rows + [(2000, None, "en", "s1"), (2001, "", None, "void"), (2002, "a b", "en", None), (3, "w", "en", "s3")]

    def test_taken(self, documents):
        rows = self.rows()
        found = mixing.taken(documents(rows)).collect()
        assert len(found) == len(rows)
        sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s))
        total = {s: 0 for s in sources}
        size = {s: sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in sources}
        source_of = {r[0]: r[3] for r in rows if r[0] != 3}
        for r in found:
            assert r["taken"] in [r["size"] * i for i in range(4)]
            assert len(r["shards"]) <= 3 and all(0 <= x < mixing.SHARDS for x in r["shards"])
            s = source_of.get(r["doc_id"], "s3")
            total[s] += r["taken"]
            assert r["source_size"] == size[s]
        targets = mixing.capped_targets([size[s] for s in sources], mixing.cycling_weights(sources), 3)
        for s, t in zip(sources, targets):
            assert abs(total[s] - t) <= 20 + size[s] / 100
        again = {tuple(map(str, r)) for r in mixing.taken(documents(rows)).collect()}
        assert again == {tuple(map(str, r)) for r in found}

    def test_mixed_rows(self, documents):
        docs = documents(self.rows())
        mixed = mixing.mixed_rows(docs)
        assert mixed.columns == docs.columns
        words = sum(len((r["text"] or "").split()) for r in mixed.collect())
        taken = sum(r["taken"] for r in mixing.taken(docs).collect())
        assert words == taken

    def test_empty(self, documents):
        assert mixing.taken(documents([])).count() == 0
        assert mixing.mixed_rows(documents([])).count() == 0


class TestLanguage:
    def test_held_out_accuracy(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        joined = language.identify(docs).join(docs, "doc_id").filter("held_out")
        right, total = joined.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
        assert total > 150 and right / total > 0.98

    def test_only_the_text_counts(self, documents):
        import zlib

        rows = [(i, f"the cat {i} and the dog" if i % 2 else f"der hund {i} und die katze", "en" if i % 2 else "de") for i in range(80)]
        odd = [(100, None, "en"), (101, "12 !? 34", "de"), (102, "", None), (103, "und die", None), (104, "THE AND " * 40_000, None)]
        odd += [(i, "wrong", "xx") for i in range(200, 400) if zlib.crc32(str(i).encode()) % 4 == 2]  # held out: not learned
        found = {r["doc_id"]: r for r in language.identify(documents(rows + odd)).collect()}
        assert {r["lang_pred"] for r in found.values()} == {"en", "de", "und"}
        for i in (100, 101, 102):
            assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0
        assert found[103]["lang_pred"] == "de" and found[104]["lang_pred"] == "en"
        assert all(0 <= r["score"] <= 1 for r in found.values())
        assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in found)

    def test_nothing_learned(self, documents):
        found = language.identify(documents([(1, "some words"), (None, "x")])).collect()
        assert [r["lang_pred"] for r in found] == ["und", "und"]
        assert language.identify(documents([])).count() == 0

    def test_kernel_counts_shared_grams(self):
        one, two = (set(language.presence_slots(t).tolist()) for t in (b"abc", b"bcd"))
        assert len(one) == 6 and len(one & two) == 3  # b, c, bc


class TestToolCalls:
    TOOLS = {"add": {"x": tool_calls.Parameter("number"), "note": tool_calls.Parameter("string", False)}}
    CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>, status int"
    RESULTS = "conv_id long, call_id string, position long, content string, level int"

    def link(self, spark, calls, results):
        calls = spark.createDataFrame([(*c, 1) for c in calls], self.CALLS)
        results = spark.createDataFrame([(*r, 1) for r in results], self.RESULTS)
        return {(r["conv_id"], r["call_id"]): r for r in tool_calls.link(calls, results, self.TOOLS).collect()}

    def test_link(self, spark):
        ok = '{"x": 1}'
        calls = [
            (1, "a", 1, "add", ok, []),
            (1, "b", 2, "add", '{"note": "n", "x": 2.5}', ["a", "zzz"]),
            (1, "c", 3, "add", '{"x": "1"}', ["a", "b", "b"]),
            (1, "d", 4, "add", '{"y": 1}', None),
            (1, "e", 5, "sub", ok, ["f"]),
            (1, "f", 6, "add", ok, ["e"]),
            (1, "g", 7, "add", ok, ["f"]),
            (1, "h", 8, "add", ok, ["h"]),
            (1, "i", 9, "add", "[1]", ["a"]),
            (1, "j", 10, "add", "{", ["i"]),
            (1, "a", 11, "add", '{"x": 9}', []),
            (None, "a", 1, "add", ok, []),
            (None, "b", 1, None, None, ["a"]),
            (2, None, 1, "add", ok, []),
        ]
        results = [(1, "a", 3, "late"), (1, "a", 2, "first \"q\"\n"), (1, "q", 9, "orphan"), (None, "a", 5, None), (3, None, 1, "x")]
        found = self.link(spark, calls, results)
        assert len(found) == 13
        assert [found[1, x]["level"] for x in "abcdefghij"] == [0, 1, 2, 0, None, None, None, None, 1, 2]
        assert found[None, "b"]["level"] == 1
        assert found[1, "a"]["repeats"] == 2 and found[1, "a"]["status"] == "ok"
        assert found[1, "b"]["status"] == "pending" and found[1, "b"]["errors"] == ""
        assert found[1, "c"]["errors"] == "x is not number"
        assert found[1, "d"]["errors"] == "missing x; unexpected y"
        assert found[1, "e"]["status"] == found[1, "g"]["status"] == "cycle" and found[1, "e"]["errors"] == "unknown tool"
        assert found[1, "i"]["errors"] == "not an object" and found[1, "j"]["errors"] == "not JSON"
        assert found[1, "q"]["status"] == "orphan" and found[1, "q"]["position"] == 9
        for r in found.values():
            record = json.loads(r["json"])
            assert r["json"] == json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert json.loads(found[1, "a"]["json"])["result"] == 'first "q"\n'
        assert json.loads(found[1, "b"]["json"])["arguments"] == {"note": "n", "x": 2.5}

    def test_empty_and_long(self, spark):
        assert self.link(spark, [], []) == {}
        long = json.dumps({"note": "é" * 200_000, "x": 1})
        found = self.link(spark, [(1, "a", 1, "add", long, [])], [(1, "a", 2, "r" * 300_000)])
        assert len(json.loads(found[1, "a"]["json"])["arguments"]["note"]) == 200_000


@pytest.mark.parametrize("kind", ["integer", "number", "string", "boolean", "array", "object", "null"])
def test_json_types(spark, kind):
    values = {"integer": "1", "number": "1.5", "string": '"s"', "boolean": "true", "array": "[1]", "object": '{"a":1}', "null": "null"}
    tools = {"t": {"v": tool_calls.Parameter(kind)}}
    rows = [(k, f'{{"v": {v}}}') for k, v in values.items()]
    frame = spark.createDataFrame(rows, "k string, a string")
    from pyspark.sql import functions as F

    fine = frame.filter(F.size(tool_calls.argument_errors(F.lit("t"), F.col("a"), tools)) == 0).collect()
    assert {r["k"] for r in fine} == ({"integer", "number"} if kind == "number" else {kind})


def one_form(text: str) -> str:
    """The form of a number that the docstring of tool_calls states, by Python's shortest digits."""
    if text.lstrip("-").isdigit():
        return str(int(text))
    value = float(text)
    if value == int(value) and abs(value) < 1e21:
        return str(int(Decimal(repr(value))))
    if 1e-6 <= abs(value) < 1e21:
        return format(Decimal(repr(value)), "f")
    digits, exponent = f"{Decimal(repr(value)).normalize():e}".split("e")
    return f"{digits}e{int(exponent):+d}"


def test_numbers_have_one_form(spark):
    numbers = (
        "0 -0 0.0 -0.0 1 100 1e2 1E+2 100.0 100.50 2.50 -2.5 1e-2 0.000001 1e-7 1.5e-7 -3.25E-9 1e21 1.5e22 1e20"
        " 123456789012345678901234567890 9007199254740993 12345678.5 0.001 0.30000000000000004 1234567890123456.7 2.5e-300"
    ).split()
    quoted = {n: json.dumps(f'{n} \\ "{n}" \\') for n in numbers}
    rows = [(i, f'{{"b": [{n}, {quoted[n]}], "a{n}": {{"x": {n}}}}}') for i, n in enumerate(numbers)]
    rows.append((len(rows), json.dumps({"s": '1.50 \\"2.50\\ ' * 50_000, "n": [1.50] * 20_000}) + " "))
    frame = spark.createDataFrame(rows, "i int, a string")
    from pyspark.sql import functions as F

    done = F.to_json(F.try_parse_json("a"))
    got = {r["i"]: r for r in frame.select("i", "a", done.alias("json"), tool_calls.canonical_numbers(done).alias("c")).collect()}
    for i, n in enumerate(numbers):
        own = one_form(n)
        assert got[i]["c"] == f'{{"a{n}":{{"x":{own}}},"b":[{own},{quoted[n]}]}}'
    last = got[len(numbers)]
    assert json.loads(last["c"]) == json.loads(last["a"])


def test_every_turn_reaches_a_record(spark):
    turns = [(c, t, role, f"{role} says {c} \"{t}\" 1.50" * (t + 1)) for c in (1, 2) for t, role in enumerate(
        ["system", "user", "assistant", "user", "assistant", "assistant", "tool", None])]
    turns += [(3, 0, "user", "opens"), (3, 1, "assistant", None), (None, 0, "user", None)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    records = tool_calls.link(*tool_calls.derived_calls(frame), tool_calls.TOOLS).collect()
    written = [r["json"] for r in records]
    for conversation, turn, role, text in turns:
        quoted = json.dumps(text, ensure_ascii=False)
        again = json.dumps(quoted[1:-1])[1:-1]  # inside arguments kept as a string
        assert text is None or any(quoted in w or again in w for w in written), (conversation, turn, role)
    assert len({(r["conv_id"], r["call_id"]) for r in records}) == len(records)
