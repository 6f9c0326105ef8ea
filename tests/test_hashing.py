"""Tokens counted over arrays: characters, digests, blocks."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from passagelake.operators import hashing
from passagelake.operators.embedding import embed, tokens


def test_digests_of_many_strings():
    chooser = random.Random(3)
    words = [bytes(chooser.choices(range(256), k=k)) for k in [*range(140)] * 3]
    want = [int.from_bytes(hashlib.md5(w).digest()[:4]) for w in words]
    for kind in (pa.binary(), pa.large_binary()):
        assert hashing.digest_heads(pa.array([b"before", *words], kind).slice(1)).tolist() == want
    assert hashing.digest_heads(pa.array([], pa.binary())).tolist() == []


def test_letters_and_digits_are_those_of_the_pattern(spark):
    """Every character of the tables and some of each other kind, alone and between letters."""
    known = [*range(0x250), *range(0x2000, 0x2070)]
    other = [0x251, 0x307, 0x3A3, 0x416, 0x4E00, 0xE000, 0xFFFD, 0x1D7D8, 0x1F600, 0x10FFFF, 0x2070, 0x20AC, 0x660]
    texts = [f"a{chr(c)}b {chr(c)}, Z{chr(c)}" for c in known + other] + ["ΟΔΟΣ İI ǅ", "Straße" + "’" + "s ﬁ"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = df.select("i", tokens(F.col("text")).alias("want"), hashing.token_text(F.col("text")).alias("text")).collect()
    words, each = hashing._tokens(pa.array([r["text"] for r in got]))
    found = [w.decode() for w in words.to_pylist()]
    ends = np.cumsum(each)
    assert [found[e - n : e] for e, n in zip(ends, each)] == [r["want"] for r in got]


@pytest.mark.parametrize("rows,size", [(4_096, 4 << 20), (3, 1 << 20), (100, 40)])
def test_blocks_do_not_change_counts(monkeypatch, rows, size):
    monkeypatch.setattr(hashing, "BLOCK_TEXTS", rows)
    monkeypatch.setattr(hashing, "BLOCK_BYTES", size)
    monkeypatch.setattr(hashing, "BLOCK_WORDS", 7)
    texts = [None, "", "ab", "ab cd", "é" * 70, " x ", "ab", None, "tail " * 50, "9", ""] * 5
    whole = pa.array(["zz", *texts, "zz"]).slice(1, len(texts))
    assert all(len(b) == 1 or (len(b) <= rows and sum(map(len, b.to_pylist())) <= size) for b in hashing.blocks(pa.array([t or "" for t in texts])))
    got = hashing.unit_counts(whole, 16).reshape(len(texts), 16)
    for text, row in zip(texts, got):
        want = np.zeros(16)
        for token in (text or "").split():
            want[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 16] += 1
        assert row.tolist() == (want / (np.linalg.norm(want) or 1)).astype(np.float32).tolist()
    assert hashing.unit_counts(pa.array([], pa.string()), 16).tolist() == []


def test_texts_go_to_the_tasks_whole(spark):
    """No array of tokens is made for a row."""
    df = spark.createDataFrame([("One two", )], "text string")
    plan = embed(df, dim=8)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan
