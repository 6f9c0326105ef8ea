"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest

from oracle_check import connect, difference
from passagelake.plans.oracle import ORACLE
from passagelake.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLE:
        assert len(got)
        return
    want = duck.execute(ORACLE[name]).df()
    # In the smallest tables every document has a vector.
    assert len(want) or name == "missing_vectors"
    assert difference(got, want) is None


def test_mllib_buckets_cover_the_collection(spark):
    told = QUERIES["kmeans_mllib"](spark, FOLDER).first()
    n = spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
    assert told.asDict() == {"buckets": 16, "vectors": n, "misplaced": 0}
