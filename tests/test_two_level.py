"""The index of two levels: both physical ways, and the recall of every number of probes."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagelake.functions.packed import as_arrays, as_bytes
from passagelake.operators import two_level
from passagelake.operators.index import assign_buckets, mean_vectors
from passagelake.operators.search import exact_search, ivf_search, recall_at_k
from passagelake.operators.two_level import (
    TwoLevel,
    assign_two_level,
    recall_curve,
    shape,
    smallest_nprobe,
    train_two_level,
)
from passagelake.sources.tables import create_collection, load_collection, write_table


@pytest.fixture(scope="module")
def rows(spark):
    """Vectors around a few centers, one of which has a third of them; some have none."""
    chooser = np.random.default_rng(1)
    centers = chooser.normal(size=(12, 6))
    pick = np.where(chooser.random(900) < 0.3, 0, chooser.integers(12, size=900))
    vectors = centers[pick] + 0.2 * chooser.normal(size=(900, 6))
    data = [(f"r{i}", "u", "t", "x", [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, pick))]
    df = spark.createDataFrame(data, "id string, url string, title string, text string, embedding array<float>, label int")
    return df.repartition(4).cache()


def placed(df):
    return {r["id"]: r["cid"] for r in df.select("id", "cid").collect()}


def test_both_ways_train_and_place_alike(spark, rows, tmp_path):
    index = train_two_level(rows, 30)
    large = train_two_level(rows, 30, small_rows=3)
    assert shape(30) == (5, 6) and index.cells.count() == 5 and 20 <= index.buckets.count() <= 30
    for mine, other in ((index.cells, large.cells), (index.buckets, large.buckets)):
        a, b = ({r["cid"]: r["c"] for r in df.collect()} for df in (mine, other))
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i]) for i in a)
    assert placed(assign_two_level(rows, index)) == placed(assign_two_level(rows, large, small_rows=3))
    # Every row lies in the nearest bucket of its nearest cell.
    cells = {r["cid"]: np.array(r["c"]) for r in index.cells.collect()}
    buckets = {r["cid"]: (r["cell"], np.array(r["c"])) for r in index.buckets.collect()}
    cosine = lambda a, b: round(a @ b / np.linalg.norm(a) / np.linalg.norm(b), 9)
    where = placed(assign_two_level(rows, index))
    for r in rows.select("id", "embedding").collect():
        v = np.array(r["embedding"], float)
        cell = max(cells, key=lambda c: (cosine(v, cells[c]), -c))
        inside = [b for b, (c, _) in buckets.items() if c == cell]
        assert where[r["id"]] == max(inside, key=lambda b: (cosine(v, buckets[b][1]), -b))
    again = index.write(str(tmp_path / "index"))
    assert again.buckets.count() == index.buckets.count() and TwoLevel.read(spark, str(tmp_path / "index")).cells.count() == 5


def test_vectors_that_are_missing_and_few_rows(spark, rows):
    few = rows.limit(3).union(rows.limit(1).select(F.lit("none"), "url", "title", "text", F.lit(None).cast("array<float>"), "label"))
    index = train_two_level(few.withColumn("id", F.concat("id", F.col("label").cast("string"))), 9)
    found = placed(assign_two_level(few, index))
    assert found["none"] is None and sum(c is not None for c in found.values()) == 3
    assert index.buckets.count() <= 3


def test_the_curve_equals_repeated_searches(spark, rows, tmp_path):
    index = train_two_level(rows, 30)
    kept = rows.drop("label")
    target = create_collection(assign_two_level(kept, index), str(tmp_path / "c"), 6)
    stored = load_collection(spark, target)
    queries = mean_vectors(rows, "label").select(F.col("label").alias("qid"), F.col("c").alias("qv"))
    queries = queries.union(rows.where("id in ('r5', 'r77', 'r200')").select(F.expr("100 + int(substr(id, 2))"), F.col("embedding").cast("array<double>")))
    exact = exact_search(queries, stored, 10, fields=[])
    curve = recall_curve(queries, exact, stored, index.buckets, 10)
    got = {r["nprobe"]: r["recall"] for r in curve.collect()}
    assert list(sorted(got)) == list(range(1, index.buckets.count() + 1)) and got[max(got)] == 1
    for nprobe in (1, 3, 8):
        found = ivf_search(queries, stored, index.buckets, 10, nprobe, fields=[])
        assert recall_at_k(exact, found, 10).first()["recall"] == pytest.approx(got[nprobe])
    least = smallest_nprobe(curve, 0.9)
    assert got[least] >= 0.9 and (least == 1 or got[least - 1] < 0.9)
    assert smallest_nprobe(curve, 2.0) == max(got)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_are_stored_as_bytes(spark, rows, monkeypatch, kind):
    """Between shuffle and training a vector is one value; training gives what it did of whole arrays."""
    stored = []
    monkeypatch.setattr(two_level, "write_table", lambda df, at: stored.append(df.schema) or write_table(df, at))
    odd = [("n", "u", "t", "x", [1.0, None] + [2.0] * 4, 0), ("e", "u", "t", "x", [], 0)]
    mixed = rows.union(spark.createDataFrame(odd, rows.schema)).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    index = train_two_level(mixed, 4, iters=1)
    assert [f.dataType.simpleString() for f in stored[0]] == ["string", "binary", "int"]
    seeds, own = {}, {r["id"]: r["embedding"] for r in mixed.collect()}
    cells = {r["id"]: r["cid"] for r in assign_buckets(mixed, index.cells).collect() if r["cid"] is not None}
    for i in sorted(cells, key=lambda i: (hashlib.md5(i.encode()).hexdigest(), i)):
        if len(seeds.setdefault(cells[i], [])) < 2:
            seeds[cells[i]].append(np.array(own[i]))
    unit = lambda v: v / np.linalg.norm(v)
    for r in index.buckets.collect():
        mine = [np.array(own[i]) for i, c in cells.items() if c == r["cell"]]
        near = [v for v in mine if np.argmax([round(unit(v) @ unit(s), 9) for s in seeds[r["cell"]]]) == r["cid"] % 2]
        assert np.allclose(r["c"], np.mean(near, axis=0))


@pytest.mark.parametrize("kind,small", [("float", 3), ("double", 16_384)])
def test_vectors_as_bytes_make_the_same_index(spark, rows, tmp_path, kind, small):
    odd = [("n", "u", "t", "x", [1.0, None] + [2.0] * 4, 0), ("e", "u", "t", "x", [], 0), ("z", "u", "t", "x", None, 0)]
    mixed = rows.union(spark.createDataFrame(odd, rows.schema)).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    write_table(as_bytes(mixed), str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    assert stored.schema["embedding"].dataType.simpleString() == "binary"
    back = as_arrays(stored)
    assert back.schema["embedding"].dataType.simpleString() == f"array<{kind}>"
    plain = {r["id"]: r["embedding"] for r in mixed.collect()}
    for r in back.collect():
        if r["id"] == "n":
            assert np.isnan(r["embedding"][1])
        else:
            assert r["embedding"] == plain[r["id"]]
    one, other = (train_two_level(df, 12, iters=1, small_rows=small) for df in (mixed, stored))
    for a, b in ((one.cells, other.cells), (one.buckets, other.buckets)):
        a, b = ({r["cid"]: r["c"] for r in df.collect()} for df in (a, b))
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i]) for i in a)
    assert placed(assign_two_level(mixed, one, small_rows=small)) == placed(assign_two_level(stored, one, small_rows=small))


def test_buckets_count_by_cell_against_the_limit_of_rows(spark, rows, monkeypatch):
    """More buckets than may be sent of a table, but few in each cell, need no shuffle of the vectors by tiles."""
    monkeypatch.setattr(two_level, "_assign_in_cells", None)
    index = train_two_level(rows, 30, small_rows=7)
    assert index.buckets.count() > 7
    found = placed(assign_two_level(rows, index, small_rows=7))
    assert found == placed(assign_two_level(rows, index))
