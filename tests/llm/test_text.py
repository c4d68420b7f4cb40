"""URL rules, byte-level BPE, HTML rendering and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from crosstally.llm import bpe, html_text, url_rules
from crosstally.llm.queries import URL_RULES

P = pytest.importorskip("public_tokenizers")
VOCABULARY = P.path("byte_bpe_50k.tiktoken")


def reference_encoder():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ENCODER = reference_encoder()
CODEC = bpe.load_codec(VOCABULARY, P.PATTERN)


def unpacked(ids):
    return np.frombuffer(bytes(ids), "<u4").tolist()


def ids_of(text):
    return unpacked(CODEC.encode(text))


class TestBpe:
    @settings(max_examples=300, deadline=None)
    @given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60))
    def test_any_text(self, text):
        assert ids_of(text) == ENCODER.encode_ordinary(text)
        assert CODEC.decode(CODEC.encode(text)) == text.encode()

    @pytest.mark.parametrize("text", ["a" * 20_000, " " * 5000, "\u2581\u2581 x", "<|endoftext|><unk>", "\0\x01\x7f", "é🤦🏼‍♂️" * 500])
    def test_odd_texts(self, text):
        assert ids_of(text) == ENCODER.encode_ordinary(text)
        assert CODEC.decode(CODEC.encode(text)) == text.encode()

    def test_all_tokens_decode(self):
        assert sorted(map(len, bpe.byte_characters())) == [1] * 256 and len(set(bpe.byte_characters())) == 256
        assert len(CODEC.tokens) == 50256

    def test_rank_gaps_are_refused(self):
        with pytest.raises(ValueError):
            bpe.read_ranks(b"YQ== 0\nYg== 2\n")

    def test_memory_is_bounded(self, monkeypatch):
        monkeypatch.setattr(bpe, "REMEMBERED", 3)
        codec = bpe.Codec(CODEC.tokens, P.PATTERN)
        for _ in range(2):
            text = "some words that are not remembered for long"
            assert codec.encode(text) == CODEC.encode(text)

    def test_rows(self, documents):
        rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "null id"), (5, "x y " * 50_000)]
        found = bpe.encode_texts(documents(rows), VOCABULARY, P.PATTERN, with_ids=True).collect()
        assert len(found) == 6
        texts = dict(rows)
        for r in found:
            text = texts[r["doc_id"]] or ""
            assert unpacked(r["ids"]) == ENCODER.encode_ordinary(text) and 4 * r["n_tokens"] == len(r["ids"])
            assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert bpe.encode_texts(documents([]), VOCABULARY, P.PATTERN).count() == 0


class TestUrlRules:
    URLS = [
        "https://WWW.Example.com/en/1?x=1#y", "http://www.example.com/en/", "http://a.example.com/en/5", "http://example.com/en",
        "http://a.net/es/1", "http://net/fr/", "ftp://x.netes/es/", "http://a.net", "http://a.net?/es/", "http://a.net#/es/",
        "//no.scheme/", "no url", "", None, "x://y://z/en/", "http://ÄB.Com/", "http://evilexample.com/en/", "http://h\nost/a\nb?c",
    ]

    def expected(self, url):
        if url is None or "://" not in url:
            return "", "", None
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return host, path, max(fits, key=lambda r: len(r.name), default=None)

    def pages(self, spark, urls):
        return spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, tokens string")

    def test_listed_rules(self, spark):
        none = url_rules.mine(spark.createDataFrame([], "url string, verdict string"))
        found = {r["page_id"]: r for r in url_rules.judge(self.pages(spark, self.URLS), URL_RULES, none).collect()}
        assert len(found) == len(self.URLS)
        for i, url in enumerate(self.URLS):
            host, path, rule = self.expected(url)
            r = found[i]
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name), url
            assert r["verdict"] == (rule.verdict if rule else "allow")

    @pytest.mark.parametrize("seed", [5, 6])
    def test_mining_equals_brute_force(self, spark, seed):
        rng = random.Random(seed)
        urls = [f"http://{rng.choice('ab')}.{rng.choice(['one', 'two'])}/{rng.choice(['en', 'buy'])}/{i}?{rng.choice('pq')}" for i in range(150)]
        rows = [(u, "block" if "/buy/" in u and "two" in u or "b.one" in u or rng.random() < 0.1 else "allow") for u in urls]
        labelled = spark.createDataFrame(rows, "url string, verdict string")
        frame = labelled.select(url_rules.all_tokens(labelled["url"]).alias("tokens"), "verdict").collect()
        blocked = Counter(t for r in frame for t in r["tokens"] if r["verdict"] == "block")
        baskets = [(frozenset(t for t in r["tokens"] if blocked[t] >= 0.05 * len(rows)), r["verdict"]) for r in frame]
        good = set()
        for tokens in {frozenset(s) for b in {b for b, _ in baskets} for n in range(1, len(b) + 1) for s in itertools.combinations(sorted(b), n)}:
            held = [v for b, v in baskets if tokens <= b]
            if held.count("block") / len(baskets) >= 0.05 and held.count("block") / len(held) >= 0.8:
                good.add(tokens)
        smallest = {t for t in good if not any(t - {x} in good for x in t)}
        mined = url_rules.mine(labelled, 0.05, 0.8)
        found = {frozenset(c) for r in mined.collect() for c in itertools.product(*(c["alike"] for c in r["classes"]))}
        assert smallest and found == smallest
        others = ["http://x.y/buy/9?q", "http://q.two/buy/1", "http://b.one/", "http://one/b", "http://a.two/en/buy?p", "http://b.two.one/x"]
        judged = url_rules.judge(self.pages(spark, urls + others), [], mined).collect()
        frame = spark.createDataFrame([(u,) for u in urls + others], "url string")
        own = [frozenset(r["t"]) for r in frame.select(url_rules.all_tokens(frame["url"]).alias("t")).collect()]
        for r in judged:
            assert r["verdict"] == ("block" if any(t <= own[r["page_id"]] for t in smallest) else "allow")

    def test_a_rule_that_labelled_urls_do_not_need_is_kept(self, spark):
        urls = [(f"http://site.org/x/buy/{i}", "block") for i in range(20)] + [(f"http://s{i}.com/x/{i}", "allow") for i in range(60)]
        mined = url_rules.mine(spark.createDataFrame(urls, "url string, verdict string"))
        judged = url_rules.judge(self.pages(spark, ["http://other.net/a/buy/9", "http://other.net/a/9", "http://new.org/"]), [], mined)
        assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {0: "block", 1: "allow", 2: "block"}

    def test_empty_pages_and_long_urls(self, spark):
        urls = [("http://a.b/bad/" + "x" * 50_000, "block"), ("http://a.b/bad/?" + "k=v&" * 5_000, "block"), ("http://a.b/good", "allow")]
        mined = url_rules.mine(spark.createDataFrame(urls, "url string, verdict string"), 0.5, 0.8)
        assert url_rules.judge(self.pages(spark, []), URL_RULES, mined).count() == 0
        long = ["http://z.z/bad/" + "/y" * 20_000, "http://z.z/?" + "&".join(f"k{i}=1" for i in range(5_000))]
        judged = url_rules.judge(self.pages(spark, long), [], mined).collect()
        assert {r["page_id"]: r["verdict"] for r in judged} == {0: "block", 1: "allow"}

    def test_nothing_to_mine(self, spark):
        for rows in ([], [("http://a.b/c", "allow")], [(None, "allow")]):
            labelled = spark.createDataFrame(rows, "url string, verdict string")
            assert url_rules.mine(labelled).count() == 0

    def test_patterns_beyond_the_first_parts(self, spark):
        """A later parameter, a deep directory and a site label over several domains and prefixes."""
        rng = random.Random(8)
        urls, bad = [], []
        for i in range(400):
            kind = i % 8
            host = f"{rng.choice(['m.', 'blog.', ''])}{'casino' if kind == 0 else 's' + str(i % 90)}.example{i % 100}.{rng.choice(['com', 'net', 'org'])}"
            third = "buy" if kind == 1 else f"t{i}"
            query = "?page=2&ref=x" if kind == 2 else "?page=2&ref=y"
            urls.append(f"http://{host}/d{i % 5}/e{i % 7}/{third}/{i}{query}")
            bad.append(kind < 3)
        rows = [(u, "block" if b else "allow") for u, b in zip(urls, bad)]
        mined = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"), 0.05, 0.8)
        judged = url_rules.judge(self.pages(spark, urls), [], mined).collect()
        assert {r["page_id"]: r["verdict"] for r in judged} == {i: "block" if b else "allow" for i, b in enumerate(bad)}

    def test_tokens_are_few(self, spark):
        url = "http://" + ".".join("abcdefgh" * 20) + "/x" * 500 + "?" + "&".join(f"k{i}=1" for i in range(500))
        frame = self.pages(spark, [url])
        row = frame.select(url_rules.tokens_of(frame["url"]).alias("t")).first()
        assert 1 < len(row["t"]) <= 9


class TestHtml:
    @pytest.mark.parametrize(
        "page, text",
        [
            (None, ""),
            ("", ""),
            ("just words\n here", "just words here"),
            ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
            ("a <b> bold </b> word&amp;&nbsp;x", "a bold word&\xa0x"),
            ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
            ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
            ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
            ("<table><tr><td>aa<td>b<tr><td>c<td>dd</table>", "aa | b\nc  | dd"),
            ("<table><td>x</table>", "x"),
            ("<table><tr><th colspan=2>wide head<tr><td>a<td>b</table>", "wide head\na | b"),
            ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in | out"),
            ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
            ("<table><tr><td>a<td rowspan=0 colspan=2>b<tr><td>c<td>d<tr><td>e</table>", "a | b\nc |     | d\ne"),
            ("<table><tr><td rowspan=3>a<td>b<tr><tr><td>c</table><p>d", "a | b\n  | c\n\nd"),
            (f"<table><tr><td>{'five ' * 13}<td>x<tr><td>b<td>{'y ' * 50}</table>",
             f"{'five ' * 12}| x\n{'five':59} |\n{'b':59} | {('y ' * 50).strip()}"),
            (f"<table><tr><td>{'w' * 70}<td>x<tr><td>b<td>y</table>", f"{'w' * 70} | x\nb | y"),
            ("<pre>a  b\n  c</pre>", "a  b\n  c"),
            ("<div hidden>x</div><div style='color:red; display : none'>y<p>z</div>w", "w"),
            ("<script>if (a<b) '</p>'</script>x<style>p{}</style><!-- c --><noscript>n</noscript>", "x"),
            ("<head><title>t</title></head><body>b", "b"),
            ("<title>t</title><p>b", "b"),
            ("<head><meta x>text", "text"),
            ("</p>x</div></b></table>", "x"),
            ("a<3 and b>2 <", "a<3 and b>2 <"),
            ("<p>cut <a href='x", "cut"),
            ("<select><option>a<option>b</select>", "a\nb"),
            ("<h1>h</h1>t<blockquote>q</blockquote>", "h\n\nt\n\n  q"),
            ("<img alt='pic'><input value=go><textarea>t <b></textarea>", "picgot <b>"),
        ],
    )
    def test_layout(self, page, text):
        assert html_text.render(page) == text

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from("<p> </p> <table> </table> <tr> <td> </td> <li> <ul> </ul> <ol> <div> </div> <b> </b> <pre> </pre>"
                                    " <br> <blockquote> </blockquote> <dd> <head> </head> <th> <hr> word <select> <option>".split()), max_size=40))  # fmt: skip
    def test_no_word_is_lost(self, parts):
        assert html_text.render("".join(parts)).count("word") == parts.count("word")

    @settings(max_examples=200, deadline=None)
    @given(st.text("<>/!-\"'=abptdrl &;", max_size=80))
    def test_anything_renders(self, page):
        html_text.render(page)

    def test_deep_and_long(self):
        assert html_text.render("<div>" * 50_000 + "x").strip() == "x"
        assert html_text.render("<b>" * 20_000 + "x" + "</b>" * 20_000) == "x"
        assert html_text.render("<a \"" * 50_000) == ""
        assert len(html_text.render("word " * 300_000)) == 5 * 300_000 - 1

    @pytest.mark.parametrize(
        "page",
        [
            "<u><table><tr><td>" + "<b>" * 60_000 + "</u>" * 60_000 + "word",
            "<ul><li>word" * 40_000,
            "<ol><li>" * 40_000 + "word</ol>" * 40_000,
            "<blockquote>word" * 40_000,
            "<table><tr><td>word" * 30_000,
            "<table><tr><td rowspan=0>" + "<td rowspan=9 colspan=9>word" * 20_000 + "<tr><td>word" * 2_000,
            "<table>" + "<tr><td>" + "word " * 50_000 + "<td>x" + "<tr><td>word<td>y" * 20_000,
            "<p>word" * 100_000 + "</td></p>" * 50_000,
        ],
        ids=range(8),
    )
    def test_work_is_linear(self, page):
        start = time.process_time()
        text = html_text.render(page)
        assert time.process_time() - start < 20
        assert text.count("word") == page.count("word") and len(text) < 100 * len(page)

    def test_rows(self, spark):
        rows = [(1, "<p>a", "t"), (1, "<p>a", "t"), (2, None, "t"), (None, "<ul><li>x", "t")]
        pages = spark.createDataFrame(rows, "page_id long, html string, text string")
        found = html_text.extract(pages).collect()
        assert sorted((r["page_id"] or 0, r["text"], r["n_lines"]) for r in found) == [(0, "- x", 1), (1, "a", 1), (1, "a", 1), (2, "", 0)]
        assert html_text.extract(pages.limit(0)).count() == 0


class TestPipeline:
    SF = "/root/testdata/sf0.001"

    def test_stages(self, spark):
        docs = spark.read.parquet(f"{self.SF}/documents.parquet")
        columns = docs.columns
        frames = []
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.saved(stage(spark, docs, self.SF), f"test_{name}")
            frames.append(docs)
        assert all(f.columns == columns for f in frames[:-1])
        rows = [[(r["doc_id"], r["text"] or "") for r in f.collect()] for f in frames[:-1]]
        raw = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{self.SF}/documents.parquet").collect()]
        assert rows[0] and all(any(c.isalpha() for c in t) for _, t in rows[0])
        assert len(rows[0]) >= 0.99 * sum(any(c.isalpha() for c in t) for _, t in raw)
        first = {}
        for i, t in sorted(rows[0]):
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
        assert sorted(i for i, _ in rows[1]) == sorted(first.values())

        def shingles(text):
            words = text.split()
            return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}

        kept = {i: shingles(t) for i, t in rows[2]}
        dropped = {i: shingles(t) for i, t in rows[1] if i not in kept}
        for a, b in itertools.combinations(sorted(kept), 2):
            assert len(kept[a] & kept[b]) < 0.8 * len(kept[a] | kept[b])
        for s in dropped.values():  # something near stays, perhaps by way of another dropped one
            others = [*kept.values(), *(o for o in dropped.values() if o is not s)]
            assert any(len(s & o) > 0.2 * len(s | o) for o in others)
        texts = dict(rows[2])
        assert {i for i, _ in rows[3]} <= set(texts)
        words = sum(len(t.split()) for _, t in rows[3])
        assert abs(words - sum(len(t.split()) for _, t in rows[2])) < 0.2 * words
        for r in frames[-1].collect():
            assert unpacked(r["ids"]) == ENCODER.encode_ordinary(texts[r["doc_id"]])

    def test_awkward_rows(self, spark, documents):
        rows = [(1, None, None, None), (2, "", "en", "a"), (3, "one word", None, None), (3, "one word", None, None)]
        rows += [(4, "123", "en", "a"), (None, "null id text", "en", "b"), (5, "w " * 30_000, "en", "a")]
        for docs in (documents(rows), documents([])):
            for name, stage in corpus_pipeline.STAGES:
                docs = corpus_pipeline.saved(stage(spark, docs, self.SF), f"test_{name}")
            docs.collect()
