"""The registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerhouse.llm import (
    byte_bpe, decontaminate, html_text, language, licences, minhash, packing, prefix_trie, quality, simhash, token_store, url_filter, whitening,
)
from layerhouse.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"), shingle=3, distance=3)


#: The rules of the query: verdict, host, start of the path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query(sql=url_filter.oracle(URL_RULES))
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs))


@query()
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.edited_likeness(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


@query()
def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored(table(spark, sf_dir, "documents"), end=0)


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=13)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), size=1024, end=2)


@query()
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), count=8)


@query()
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    found = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), *ranks), *ranks)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"), block=20, most=4)
