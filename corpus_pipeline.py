"""From raw documents to token files, by the operators of ``passagelake.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and
read back as the next one's ``docs``.  All but the last return the columns of ``docs``.
Columns the stages don't need pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from passagelake.llm import language_id
from passagelake.llm.common import crc32_of, stored
from passagelake.llm.decontaminate import contaminated
from passagelake.llm.mixing import mix_sources
from passagelake.llm.queries import END_ID, tokenizer_path
from passagelake.llm.simhash import near_duplicates
from passagelake.llm.token_files import token_roundtrip

#: Documents whose best language holds a smaller share of their trigrams are rejected.
LANGUAGE_SHARE = 0.4


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells rows apart by doc_id (null too) and text, and its name."""
    key = next(f"row key {i}" for i in range(len(docs.columns) + 1) if f"row key {i}" not in docs.columns)
    return docs.withColumn(key, F.struct("doc_id", F.xxhash64("text").alias("tie"))), key


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the labelled ones; those without a letter or with too
    few known trigrams go."""
    held = language_id.held_out(crc32_of("doc_id"))
    model = language_id.train(docs.where(~held).select("text", "lang"))
    plain = docs.toDF(*[c if c == "text" else f"column {i}" for i, c in enumerate(docs.columns)])
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LANGUAGE_SHARE)
    kept = language_id.with_language(plain, model).where(known)
    return kept.select(*plain.columns).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that the SimHash operator links;
    null ids come last.  Rows that repeat doc_id and text are one row."""
    grouped = near_duplicates(docs.select("doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("first")
    stay = grouped.groupBy("root").agg(first).select(F.struct("first.doc_id", "first.tie").alias("stays"))
    keyed, key = _keyed(docs)
    return keyed.join(stay, keyed[key] == stay["stays"], "left_semi").dropDuplicates([key]).drop(key)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; rows are told apart by doc_id and text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    keyed, key = _keyed(docs)
    found = contaminated(keyed.select(keyed[key].alias("doc_id"), "text"), items)
    leaks = found.select(F.col("doc_id").alias("leaks")).distinct()
    return keyed.join(leaks, keyed[key] == leaks["leaks"], "left_anti").drop(key)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none to three times.  Rows are told apart
    by doc_id and text; those that repeat both share what the mix takes of them."""
    keyed, key = _keyed(docs)
    taken = mix_sources(keyed.select(keyed[key].alias("doc_id"), "text", "source")).groupBy("doc_id").agg(
        F.sum("taken").alias("taken"), F.sum("size").alias("size")
    ).where("size > 0")
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    counted = taken.select(F.col("doc_id").alias("mixed"), times.alias("times")).where("times > 0")
    every = [keyed[c] for c in docs.columns]
    copies = F.explode(F.sequence(F.lit(1), counted["times"]))
    mixed = keyed.join(counted, keyed[key] == counted["mixed"])
    return mixed.select(*every, copies.alias("copy number of the mix")).drop("copy number of the mix")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row per document in them."""
    return token_roundtrip(docs.select("doc_id", "text"), tokenizer_path(), END_ID, by_words=True, width=2)


STAGES = [
    ("language identification", language_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("token files", token_stage),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
