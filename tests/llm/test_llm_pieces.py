"""Batches cut into many pieces, and arrays that don't start at offset 0, change no result."""

import math

import numpy as np
import pyarrow as pa
import pytest

from conftest import edge_texts, prose, rows_of
from passagelake.llm import class_lm, common, language_id, mixing, simhash, substring_dedup, token_files, warc  # noqa: F401
from passagelake.llm.common import Words, pieces
from passagelake.llm.queries import LLM_QUERIES

TEXTS = [t for _, t in edge_texts()] + [prose(s, 40).upper() for s in range(20)]


def words_of(array, lower):
    found = Words(array, lower)
    names = [found.vocabulary[i] for i in found.ids]
    return [names[a:b] for a, b in zip(found.starts[:-1], found.starts[1:], strict=True)]


@pytest.mark.parametrize("lower", [False, True])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_slices(lower, kind):
    whole = pa.array(TEXTS, kind)
    want = [(t or "").encode() for t in TEXTS]
    want = [(t.lower() if lower else t).split() for t in want]
    assert words_of(whole, lower) == want
    for start in range(0, len(TEXTS), 5):
        for n in (0, 1, 3, len(TEXTS)):
            assert words_of(whole.slice(start, n), lower) == want[start : start + n]


def test_pieces_cover_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS), pa.array(range(len(TEXTS)))], names=["text", "n"]).slice(3)
    for size in (1, 300, 1 << 20):
        parts = list(pieces(batch, size=size))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert len(list(pieces(batch, size=300))) > 5


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 300)
    monkeypatch.setattr(language_id, "PIECE", 300)


@pytest.mark.parametrize("name", ["op2_token_files", "op3_substring_dedup", "op5_language_id", "op7_simhash", "op9_warc"])
def test_queries_in_many_pieces(spark, small, monkeypatch, name):
    folder = "/root/testdata/sf0.001"
    got = rows_of(LLM_QUERIES[name](spark, folder), "*")
    monkeypatch.undo()
    assert got == rows_of(LLM_QUERIES[name](spark, folder), "*")


def expected_base(rows):
    """(doc_id, n_tokens, n_known, train_tokens, base_score) as the contract words it."""
    from collections import Counter
    from zlib import crc32

    held = [i is not None and crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    c = Counter(w for h, ws in zip(held, tokens, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    out = []
    for (i, _), ws in zip(rows, tokens, strict=True):
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((i, len(ws), sum(c[w] > 0 for w in ws), n, base))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece", [300, 8 << 20])
def test_base_scores_against_the_contract(spark, monkeypatch, piece):
    monkeypatch.setattr(class_lm, "PIECE", piece)
    rows = edge_texts() + [(100 + s, prose(s, 60).upper()) for s in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = class_lm.score_texts(docs, class_lm.held_out(), frequent=30)
    got = rows_of(found, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    want = expected_base(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9)


def test_base_scores_of_a_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = LLM_QUERIES["op8_class_lm"](spark, folder)
    got = rows_of(found, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    want = expected_base(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9)
