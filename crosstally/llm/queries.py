"""The registered queries of this package: thin applications of its operators to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crosstally.llm import (
    bpe, cover_codes, decontaminate, digest_index, html_text, language, mixing, order_minhash, phrases, suffix_dedup,
    tool_calls, topk, url_rules,
)
from crosstally.llm.common import table


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.derived_calls(table(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, tool_calls.TOOLS)


def op3_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_dedup(table(spark, sf_dir, "documents"), digest_index.DigestIndex(spark))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter(F.pmod("vec_id", F.lit(50)) == 0), vectors, 5)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.taken(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


#: The listed rules of the contract: fixed values.
URL_RULES = (
    url_rules.Rule("allow", "com", "/"),
    url_rules.Rule("block", "example.com", "/en/"),
    url_rules.Rule("allow", "www.example.com", "/en/"),
    url_rules.Rule("block", "net", "/es/"),
    url_rules.Rule("block", "net", "/fr/"),
)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    mined = url_rules.mine(url_rules.label_urls(pages, labels, URL_RULES))
    return url_rules.judge(pages, URL_RULES, mined)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_cover_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = cover_codes.compress(table(spark, sf_dir, "embeddings"))
    return cover_codes.with_label_errors(done.codes).select(
        "vec_id",
        cover_codes.hex_code("code").alias("code"),
        "error",
        "label_error",
        F.lit(done.codebooks_sha256()).alias("codebooks_sha256"),
    )


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_order_minhash,
        op2_tool_calls,
        op3_string_kernel,
        op4_digest_index,
        op5_topk,
        op6_suffix_dedup,
        op7_mixing,
        op8_url_rules,
        op9_byte_bpe,
        op10_html_text,
        op11_phrases,
        op12_cover_codes,
        op13_decontaminate,
    )
}
