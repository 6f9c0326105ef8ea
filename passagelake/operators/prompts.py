"""Hits to prompts, sources and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from passagelake.config import GENERATE_BATCH, NO_CONTEXT_ANSWER, system_prompt
from passagelake.functions.text import context_block, messages, user_message
from passagelake.operators.batching import call_in_batches

Generator = Callable[[list[list[dict]]], list[str]]


def _in_rank_order(value: Column) -> Column:
    """Values of a group as an array by rank; a group has at most k hits."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rk"), value.alias("value"))))
    return F.transform(ordered, lambda x: x["value"])


def contexts(hits: DataFrame) -> DataFrame:
    """``(qid, context)``: numbered passages in rank order, blank lines between."""
    block = context_block(F.col("rk"), F.coalesce("text", F.lit("")))
    return hits.groupBy("qid").agg(F.array_join(_in_rank_order(block), "\n\n").alias("context"))


def build_prompts(
    queries: DataFrame, hits: DataFrame, system_text: str | None = None
) -> DataFrame:
    """``(qid, messages)``; ``messages`` is null for a query without hits."""
    asked = queries.select("qid", "qtext").join(contexts(hits), "qid", "left")
    system_text = system_prompt() if system_text is None else system_text
    chat = messages(system_text, user_message(F.col("context"), F.col("qtext")))
    return asked.select("qid", F.when(F.col("context").isNotNull(), chat).alias("messages"))


def answer_sources(hits: DataFrame) -> DataFrame:
    """``(qid, i, title, url)``, one row per cited passage."""
    return hits.select(
        "qid", F.col("rk").alias("i"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("url", F.lit("")).alias("url"),
    )


def source_lists(hits: DataFrame) -> DataFrame:
    """``(qid, sources)``: the numbered source lines of an answer."""
    line = F.format_string(
        "[%d] %s\n%s", "rk", F.coalesce("title", F.lit("")), F.coalesce("url", F.lit(""))
    )
    return hits.groupBy("qid").agg(F.array_join(_in_rank_order(line), "\n").alias("sources"))


def generate(
    prompts: DataFrame, generator_factory: Callable[[], Generator], batch: int = GENERATE_BATCH,
    budget: int | None = None, errors: str | None = None,
) -> DataFrame:
    """``(qid, answer)``: one stripped answer per prompt.

    ``generator_factory`` makes, inside the task, a function from up to ``batch`` message
    lists of similar length to as many texts; all counted as the longest, they have at most ``budget``
    characters.  A query without context gets the fixed answer and no call.  A prompt that the generator
    fails on fails the job, unless ``errors`` names a column for what went wrong: its answer is then null.
    """

    def length(chat: list[dict]) -> int:
        return sum(len(m["content"] or "") for m in chat)

    def answer(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generator = generator_factory()  # once per task
        for column in columns:
            texts, wrong = call_in_batches(column.to_pylist(), generator, batch, budget, length, errors is not None)
            yield pa.StructArray.from_arrays(
                [pa.array([t and t.strip() for t in texts], pa.string()), pa.array(wrong, pa.string())], names=["text", "error"]
            )

    answer.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    called = prompts.select("qid", "messages", F.arrow_udf(answer, "text string, error string")(F.col("messages")).alias("_told"))
    text = F.when(F.col("messages").isNull(), F.lit(NO_CONTEXT_ANSWER)).otherwise(F.col("_told.text"))
    told = [F.col("_told.error").alias(errors)] if errors else []
    return called.select("qid", text.alias("answer"), *told)


def answers_with_sources(answers: DataFrame, hits: DataFrame) -> DataFrame:
    """``(qid, answer, sources)``."""
    return answers.join(source_lists(hits), "qid", "left").select(
        "qid", "answer", F.coalesce("sources", F.lit("")).alias("sources")
    )
