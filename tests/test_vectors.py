import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagelake import schema
from passagelake.functions import vectors as V
from passagelake.operators.embedding import embed, embed_queries, encoder_of, missing_vectors


def test_measures(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-2.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    got = df.select(
        V.cosine_similarity(a, b), V.inner_product(a, b), V.l2_distance(a, b), V.l2_norm(a)
    ).collect()
    assert tuple(got[0]) == pytest.approx((0.96, 24.0, math.sqrt(2), 5.0))
    assert tuple(got[1]) == pytest.approx((0.0, 0.0, 1.0, 0.0))
    assert tuple(got[2]) == pytest.approx((-1.0, -2.0, 3.0, 1.0))
    units = [r[0] for r in df.select(V.l2_normalize(a)).collect()]
    assert units == [[0.6, 0.8], [0.0, 0.0], [1.0, 0.0]]


def test_dim_check_is_never_null(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [1.0, None])], "i int, v array<float>"
    )
    got = {r[0]: r[1] for r in df.select("i", V.has_dim(F.col("v"), 2)).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False}


def test_hashing_counts_tokens(spark):
    df = spark.createDataFrame([(0, "One two TWO"), (1, "two two one"), (2, "--"), (3, None)], "i int, text string")
    got = {r["i"]: r["embedding"] for r in embed(df, dim=32).collect()}
    assert np.linalg.norm(got[0]) == pytest.approx(1, abs=1e-6)
    assert got[0] == got[1]
    assert sorted(x for x in got[0] if x) == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert got[2] == got[3] == [0.0] * 32


def test_hashing_over_blocks_of_texts(spark):
    """Every bucket holds the count of the tokens whose MD5 says so; no digest is made per row."""
    texts = [f"Wörter {i} und {i % 7} words, {i % 3}" for i in range(5000)] + [None, "", "..."]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(2)
    vectors = embed(df, dim=48)
    for row in vectors.collect():
        want = np.zeros(48)
        for token in re.findall(r"\w+", (row["text"] or "").lower()):
            want[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 48] += 1
        want /= np.linalg.norm(want) or 1
        assert row["embedding"] == want.astype(np.float32).tolist()
    assert "md5(" not in vectors._jdf.queryExecution().optimizedPlan().toString()


def test_callers_encoder_is_batched_and_normalised(spark):
    def factory():
        def encode(texts):
            assert 0 < len(texts) <= 3
            return [[3.0 * len(t), 4.0 * len(t)] for t in texts]

        return encode

    df = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(20)] + [(99, None)], "i int, text string")
    got = {r["i"]: r["embedding"] for r in embed(df, factory, 2, encoder_id="len", batch=3).collect()}
    assert got[7] == pytest.approx([0.6, 0.8]) and got[99] is None and len(got) == 21


def test_stored_vectors_are_kept(spark):
    def factory():
        def encode(texts):
            assert "have" not in texts
            return [[3.0 * len(t), 4.0 * len(t)] for t in texts]

        return encode

    df = spark.createDataFrame(
        [("a", "have", [1.0, 0.0]), ("b", "want", None), ("c", "want too", [1.0, 2.0, 3.0])],
        "id string, text string, embedding array<float>",
    )
    assert {r["id"] for r in missing_vectors(df, 2).collect()} == {"b", "c"}
    got = {r["id"]: r["embedding"] for r in embed(df, factory, 2, encoder_id="len").collect()}
    assert got["a"] == [1.0, 0.0]
    assert got["b"] == got["c"] == pytest.approx([0.6, 0.8])


def test_wrong_width_and_missing_name_are_refused(spark):
    def lengths():
        return lambda texts: [[3.0 * len(t), 4.0 * len(t)] for t in texts]

    df = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(ValueError, match="encoder_id"):
        embed(df, lengths, 2)
    with pytest.raises(Exception, match="encoder returned"):
        embed(df, lengths, 3, encoder_id="len").collect()


def test_encoder_name_survives_a_file(spark, tmp_path):
    df = embed(spark.createDataFrame([("x",)], "text string"), dim=8)
    df.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert encoder_of(stored, "embedding") == "hashing-md5-8"
    queries = embed_queries(spark.createDataFrame([(1, "x")], "qid long, qtext string"), dim=8)
    assert encoder_of(queries, "qv") == "hashing-md5-8"


def collection(spark, rows):
    return spark.createDataFrame(
        rows, "id string, url string, title string, text string, embedding array<float>"
    )


def test_violations(spark):
    df = collection(spark, [
        ("ok", "u", "t", "x", [1.0, 2.0]),
        ("i" * 129, "u" * 513, "t" * 513, "x" * 4097, [1.0]),
        (None, "u", "t", "x", None),
        ("edge" + "i" * 124, "u" * 512, "t" * 512, "x" * 4096, [1.0, 2.0]),
    ])
    got = sorted((r["id"] or "", r["rule"]) for r in schema.validate_schema(df, 2).collect())
    assert got == sorted([
        ("i" * 129, f"{f}_too_long") for f in ("id", "url", "title", "text")
    ] + [("i" * 129, "embedding_dim"), ("", "id_missing"), ("", "embedding_dim")])
    with pytest.raises(ValueError, match="extra"):
        schema.validate_schema(df.withColumn("other", F.lit(1)))
    with pytest.raises(ValueError, match="missing"):
        schema.validate_schema(df.drop("url"))
    with pytest.raises(Exception, match="breaks .*embedding_dim"):
        schema.checked(df, 2).collect()
    assert schema.checked(df.where("id = 'ok'"), 2).count() == 1


def test_duplicate_keys(spark):
    rows = [("a", "u", "t", "x", [1.0])] * 3 + [("b", "u", "t", "x", [1.0])]
    got = schema.duplicate_keys(collection(spark, rows)).collect()
    assert [tuple(r) for r in got] == [("a", 3)]
