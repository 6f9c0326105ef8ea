"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from passagelake.llm import class_lm, language_id
from passagelake.llm.common import crc32_of
from passagelake.llm.conversation_repair import damaged, repair
from passagelake.llm.decontaminate import contaminated
from passagelake.llm.exact_dedup import exact_dedup
from passagelake.llm.hard_negatives import hard_negatives
from passagelake.llm.mixing import mix_sources
from passagelake.llm.oracle import LLM_ORACLE  # noqa: F401
from passagelake.llm.projection_forest import search
from passagelake.llm.simhash import hex_fingerprint, near_duplicates
from passagelake.llm.substring_dedup import substring_dedup
from passagelake.llm.token_files import token_roundtrip
from passagelake.llm.url_filter import filter_urls
from passagelake.llm.warc import warc_roundtrip

#: Rules of the url query: (host, path, verdict).
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

#: Vocabulary file of the token query, and the id that ends a document.
TOKENIZER, END_ID = "word_bpe_49k.json", 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _read(spark: SparkSession, sf: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet").select(*columns)


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(_read(spark, sf, "documents", "doc_id", "text"))


def op2_token_files(spark: SparkSession, sf: str) -> DataFrame:
    documents = _read(spark, sf, "documents", "doc_id", "text")
    return token_roundtrip(documents, tokenizer_path(), END_ID, by_words=True, width=2)


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup(_read(spark, sf, "documents", "doc_id", "text"))


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(
        _read(spark, sf, "documents", "doc_id", "text"), _read(spark, sf, "benchmark", "item_id", "text")
    )


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = _read(spark, sf, "documents", "doc_id", "text", "lang")
    held = language_id.held_out(crc32_of("doc_id"))
    model = language_id.train(documents.where(~held).select("text", "lang"))
    asked = documents.select("doc_id", held.alias("held_out"), "text")
    return language_id.identify(asked, model).select("doc_id", "held_out", "lang_pred", "score")


def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return filter_urls(_read(spark, sf, "pages", "page_id", "url"), rules)


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates(_read(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def op8_class_lm(spark: SparkSession, sf: str) -> DataFrame:
    documents = _read(spark, sf, "documents", "doc_id", "text")
    scored = class_lm.score_texts(documents, class_lm.held_out())
    return scored.select(
        "doc_id", class_lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc_roundtrip(_read(spark, sf, "pages", "page_id", "url", "html"))


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix_sources(_read(spark, sf, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair(damaged(_read(spark, sf, "conversations", "conv_id", "turn", "role", "text")))


def op12_projection_forest(spark: SparkSession, sf: str) -> DataFrame:
    return search(_read(spark, sf, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _read(spark, sf, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_token_files, op3_substring_dedup, op4_decontaminate, op5_language_id,
        op6_url_filter, op7_simhash, op8_class_lm, op9_warc, op10_mixing, op11_conversation_repair,
        op12_projection_forest, op13_hard_negatives,
    )
}
