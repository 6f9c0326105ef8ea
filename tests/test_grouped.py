"""How a collection by groups is written."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from passagelake.operators.two_level import train_two_level
from passagelake.sources import grouped
from passagelake.sources.tables import create_collection


def test_key_filter_has_the_bits_of_every_key(spark, tmp_path):
    ids = spark.range(700).select(F.concat(F.lit("key "), "id").alias("id")).union(spark.sql("select 'key 5'"))
    _, version, blocks = grouped._write_keys(ids, str(tmp_path), 1)
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/keys/version={version}").select("block", "word", "bits").collect()}
    want = grouped._probes(ids, blocks).groupBy("block", "word").agg(F.bit_or("bit"))
    assert got == {tuple(r) for r in want.collect()} and any(bits < 0 for *_, bits in got)
    plan = grouped._key_words(ids, blocks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [block") > plan.index("Generate")  # keys aren't multiplied by their bits before


def test_numbers_of_vectors_are_written_plainly(spark, tmp_path):
    rows = [(f"r{i}", "u", "t", "x", [i / 7, 1.0], i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "id string, url string, title string, text string, embedding array<float>, cid int")
    create_collection(df, str(tmp_path / "c"), 2)
    files = glob.glob(f"{tmp_path}/c/rows/**/*.parquet", recursive=True)
    assert files
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        used = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
        assert not any("DICTIONARY" in e for e in used["embedding.list.element"])
        assert any("DICTIONARY" in e for e in used["url"])


def test_sizes_that_are_known_are_not_counted(spark, tmp_path, monkeypatch):
    """Groups come from the given sizes; rows without a bucket are refused all the same."""
    schema = "id string, url string, title string, text string, embedding array<float>, cid int"
    df = spark.createDataFrame([(f"r{i}", "u", "t", "x", [1.0, 2.0], i % 5) for i in range(50)], schema)
    monkeypatch.setattr(grouped, "LEAST_ROWS", 1)
    seen = []
    monkeypatch.setattr(grouped, "packed", lambda sizes: seen.append(sizes) or [0, 2])
    monkeypatch.setattr(type(df), "groupBy", None)
    target = str(tmp_path / "c")
    grouped.create(df, target, 100, keys=False, sizes=[(0, 9), (2, 30)])
    monkeypatch.undo()
    assert seen == [[(0, 9), (2, 30)]]
    stored = grouped.read(spark, target)
    assert {(r["cid"], r["grp"]) for r in stored.collect()} == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 1)} and stored.count() == 50
    odd = df.union(spark.createDataFrame([("none", "u", "t", "x", [1.0, 2.0], None)], schema))
    with pytest.raises(Exception, match="rows without a bucket"):
        grouped.create(odd, str(tmp_path / "d"), 100, sizes=[(0, 9)])
    assert not grouped.is_grouped(spark, str(tmp_path / "d"))


def test_training_tells_the_sizes(spark):
    rows = [(f"r{i}", [float(i % 3), 1.0, float(i % 2)]) for i in range(60)]
    index = train_two_level(spark.createDataFrame(rows, "id string, embedding array<float>"), 4)
    assert sum(n for _, n in index.sizes) == 60
    assert {cid for cid, _ in index.sizes} <= {r["cid"] for r in index.buckets.collect()}
    without = spark.createDataFrame([*rows, ("none", None)], "id string, embedding array<float>")
    assert train_two_level(without, 4).sizes is None
