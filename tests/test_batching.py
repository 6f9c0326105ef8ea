"""Calls of a model: packing by length, and inputs that fail."""

import random

import pytest
from pyspark.sql import functions as F

from passagelake.operators.batching import call_in_batches, packed
from passagelake.operators.embedding import embed
from passagelake.operators.prompts import generate


def padding(calls, lengths):
    return sum(len(c) * max(lengths[i] for i in c) - sum(lengths[i] for i in c) for c in calls)


def test_similar_lengths_share_a_call():
    chooser = random.Random(1)
    lengths = [int(chooser.lognormvariate(5, 1)) + 1 for _ in range(1000)]
    calls = packed(lengths, 32, None)
    assert sorted(i for c in calls for i in c) == list(range(1000)) and max(map(len, calls)) == 32
    as_they_come = [list(range(i, min(i + 32, 1000))) for i in range(0, 1000, 32)]
    assert padding(calls, lengths) < padding(as_they_come, lengths) / 5
    bounded = packed(lengths, 32, 2000)
    assert all(len(c) * max(lengths[i] for i in c) <= 2000 or len(c) == 1 for c in bounded)
    assert packed([], 4, 10) == [] and packed([0, 0, 0], 2, 0) == [[0, 1], [2]]


def test_results_keep_their_rows_and_errors_stand_alone():
    calls = []

    def call(xs):
        calls.append(len(xs))
        if any("bad" in x for x in xs):
            raise RuntimeError("no " + xs[0])
        return [x.upper() for x in xs]

    inputs = ["a", None, "bad", "ccc", "dd", None, "e" * 9, "bad bad"]
    results, errors = call_in_batches(inputs, call, 8, split_errors=True)
    assert results == ["A", None, None, "CCC", "DD", None, "E" * 9, None]
    assert [i for i, e in enumerate(errors) if e] == [2, 7] and errors[2] == "RuntimeError: no bad"
    assert len(calls) <= 11
    with pytest.raises(RuntimeError):
        call_in_batches(inputs, call, 8)
    with pytest.raises(ValueError, match="1 results for 2 inputs"):
        call_in_batches(["a", "b"], lambda xs: xs[:1], 8)
    assert call_in_batches([None, None], call, 8) == ([None, None], [None, None])


def test_a_bad_text_costs_its_row(spark):
    def factory():
        def encode(texts):
            if any(t == "bad" for t in texts):
                raise RuntimeError("cannot read this")
            return [[1.0 * len(t), 1.0] for t in texts]

        return encode

    rows = spark.createDataFrame([(i, "bad" if i == 7 else None if i == 8 else "x" * i) for i in range(300)], "id int, text string")
    told = embed(rows.coalesce(1), factory, 2, encoder_id="lengths", budget=500, errors="wrong")
    got = {r["id"]: r for r in told.collect()}
    assert got[7]["embedding"] is None and got[7]["wrong"] == "RuntimeError: cannot read this"
    assert got[8]["embedding"] is None and got[8]["wrong"] is None
    assert all(len(r["embedding"]) == 2 and r["wrong"] is None for i, r in got.items() if i not in (7, 8))
    with pytest.raises(Exception, match="cannot read this"):
        embed(rows, factory, 2, encoder_id="lengths").collect()
    # The next run has only the row that failed to encode again.
    again = embed(told.withColumn("text", F.coalesce("text", F.lit("y"))), factory, 2, encoder_id="lengths", errors="wrong")
    assert [r["id"] for r in again.where("wrong is not null").collect()] == [7]


def test_a_prompt_that_fails_costs_its_answer(spark):
    chats = [(i, None if i == 2 else [{"role": "user", "content": "bad" if i == 1 else f" q{i} "}]) for i in range(6)]
    prompts = spark.createDataFrame(chats, "qid int, messages array<struct<role: string, content: string>>")

    def generator():
        def answer(batch):
            if any(c[0]["content"] == "bad" for c in batch):
                raise RuntimeError("refused")
            return [c[0]["content"] for c in batch]

        return answer

    got = {r["qid"]: (r["answer"], r["wrong"]) for r in generate(prompts.coalesce(1), generator, budget=8, errors="wrong").collect()}
    assert got[1] == (None, "RuntimeError: refused") and got[0] == ("q0", None)
    assert got[2][0].startswith("No relevant context") and got[2][1] is None
    with pytest.raises(Exception, match="refused"):
        generate(prompts, generator).collect()
