"""Search against brute force on small collections, copies and crowded buckets included."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagelake.operators import index as I
from passagelake.operators.nearest import nearest
from passagelake.operators.search import (
    as_nested_hits,
    described_hits,
    exact_search,
    ivf_search,
    recall_at_k,
    single_query_search,
)

DIM = 6


def unit(x):
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norms == 0, 1, norms)


def score_all(q, v, metric):
    if metric == "cosine":
        s = unit(q) @ unit(v).T
    elif metric == "ip":
        s = q @ v.T
    else:
        s = np.sqrt(((q[:, None] - v[None]) ** 2).sum(2))
    return np.round(s, 9)


def brute(qids, q, ids, v, k, metric, allowed=None):
    scores = score_all(q, v, metric)
    out = []
    for a, qid in enumerate(qids):
        rows = [b for b in range(len(ids)) if allowed is None or allowed[a, b]]
        rows.sort(key=lambda b: (scores[a, b] if metric == "l2" else -scores[a, b], ids[b]))
        out += [(qid, r + 1, ids[b], pytest.approx(scores[a, b], abs=1e-8)) for r, b in enumerate(rows[:k])]
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(700, DIM)).astype(np.float32).astype(float)
    v[::3] = v[0]  # a third of all rows are copies of one
    v[7] = 0
    order = rng.permutation(700)
    ids = [f"r{n:04d}" for n in order]
    q = np.vstack([v[0] * 2, rng.normal(size=(8, DIM)), np.zeros((1, DIM))])
    return [f"q{n}" for n in range(len(q))], q, ids, v


@pytest.fixture(scope="module")
def frames(spark, data):
    qids, q, ids, v = data
    queries = spark.createDataFrame(list(zip(qids, q.tolist())), "qid string, qv array<double>")
    items = spark.createDataFrame(
        [(i, f"u/{i}", f"t {n % 4}", f"text {i}", x) for n, (i, x) in enumerate(zip(ids, v.tolist()))],
        "id string, url string, title string, text string, embedding array<float>",
    ).repartition(5)
    return queries.cache(), items.cache()


def rows(hits):
    return [tuple(r) for r in hits.select("qid", "rk", "id", "score").orderBy("qid", "rk").collect()]


WAYS = {
    "few queries": {},
    "few items": {"items_first": True},
    "tiles": {"small_rows": 1, "tile_queries": 3, "tile_items": 50},
    "one tile": {"small_rows": 1},
}


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
@pytest.mark.parametrize("way", WAYS)
def test_three_ways_equal_brute_force(data, frames, way, metric):
    got = rows(nearest(*frames, k=7, metric=metric, **WAYS[way]))
    assert got == brute(*data, 7, metric)


def test_k_larger_than_the_collection(data, frames):
    queries, items = frames
    got = rows(nearest(queries, items.where("title = 't 1'"), k=500))
    qids, q, ids, v = data
    keep = [n for n in range(len(ids)) if n % 4 == 1]
    assert got == brute(qids, q, [ids[n] for n in keep], v[keep], 500, "cosine")


def test_many_blocks_in_one_task(data, frames, monkeypatch):
    from passagelake.operators import nearest as module

    best = module._Best(module.prepared(data[1], "cosine"), 5, "cosine")
    monkeypatch.setattr(module, "_BLOCK_SCORES", 40)
    best.offer(np.array(data[2], dtype=object), module.prepared(data[3], "cosine"))
    got = [(data[0][q], i) for q, i in zip(best.rows["q"], best.rows["id"])]
    assert got == [(r[0], r[2]) for r in brute(*data, 5, "cosine")]


def test_rows_without_a_usable_vector_are_left_out(spark, data, frames):
    queries, items = frames
    bad = spark.createDataFrame(
        [("x1", "u", "t 1", "", None), ("x2", "u", "t 1", "", []), ("x3", "u", "t 1", "", [1.0] * 5 + [None]),
         ("x4", "u", "t 1", "", [float("nan")] * 6)], items.schema)
    odd = spark.createDataFrame([("q98", None), ("q99", [])], queries.schema)
    for way in WAYS.values():
        found = nearest(queries.union(odd), items.union(bad).repartition(3), **way)
        assert rows(found) == brute(*data, 5, "cosine")
    trained = I.train_centroids(items.union(bad), nlist=9, iters=2)
    assert centers(trained) == pytest.approx(lloyd(data[2], data[3], 9, 2))
    placed = I.assign_buckets(items.union(bad), trained)
    assert {r["id"] for r in placed.where("cid is null").collect()} == {"x1", "x2", "x3", "x4"}


def test_repeated_and_null_ids_have_one_answer(spark):
    """Vectors of one qid are one query, those of one id one item, in every way."""
    rng = np.random.default_rng(8)
    asked = [("a", rng.normal(size=DIM)), ("b", rng.normal(size=DIM)), ("a", rng.normal(size=DIM)), (None, rng.normal(size=DIM))]
    asked += [asked[0], (None, rng.normal(size=DIM))]
    held = [(f"r{n % 60}", rng.normal(size=DIM)) for n in range(150)] + [("r7", asked[0][1])] * 9 + [(None, asked[1][1])]
    queries = spark.createDataFrame([(q, x.tolist()) for q, x in asked], "qid string, qv array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in held], "id string, embedding array<double>").repartition(4)
    want = {}
    for q, x in asked:
        for i, y in held:
            if i is not None:
                score = float(score_all(x[None], y[None], "cosine")[0, 0])
                want[q, i] = max(want.get((q, i), -2.0), score)
    best = []
    for q in ("a", "b", None):
        order = sorted((-s, i) for (p, i), s in want.items() if p == q)[:7]
        best += [(q, r + 1, i, pytest.approx(-s, abs=1e-8)) for r, (s, i) in enumerate(order)]
    for way in WAYS.values():
        found = nearest(queries, items, k=7, **way).orderBy(F.asc_nulls_last("qid"), "rk")
        assert [tuple(r) for r in found.collect()] == best
    centroids = spark.createDataFrame([(c, rng.normal(size=DIM).tolist()) for c in range(5)], "cid int, c array<double>")
    for small_rows in (1000, 2):
        placed = I.assign_buckets(items, centroids, small_rows=small_rows)
        assert placed.count() == len(held)
        got = {(r["id"], tuple(r["embedding"])): r["cid"] for r in placed.collect()}
        near = assign(np.array([y for _, y in held]), centers(centroids))
        assert got == {(i, tuple(y)): c for (i, y), c in zip(held, near)}
    celled = I.assign_buckets(items, centroids)
    for nprobe in (1, 5):
        few, many = (
            ivf_search(queries, celled, centroids, nprobe=nprobe, fields=[], small_rows=n).orderBy(F.asc_nulls_last("qid"), "rk").collect()
            for n in (1000, 1)
        )
        assert [r[:3] for r in few] == [r[:3] for r in many]


def test_nothing_above_the_limit_is_fetched(spark, monkeypatch):
    """Wide vectors: measured by the tasks, left where they are."""
    from pyspark.sql.classic.dataframe import DataFrame

    from passagelake.session import small_table

    fetched, whole = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: fetched.append(whole(self)) or fetched[-1])
    wide = spark.range(50).select(F.col("id").alias("qid"), F.array_repeat(F.lit(1.0), 1000).alias("qv"))
    assert small_table(wide, 100, 300_000) is None and not fetched
    assert small_table(wide, 49, 10**9) is None and not fetched
    assert small_table(wide, 50, 500_000).num_rows == 50
    marked = wide.withColumn("qv", F.col("qv").alias("qv", metadata={"dim": 1000}))
    assert small_table(marked, 100, 300_000) is None and len(fetched) == 1


def test_vectors_of_different_width_are_refused(spark, frames):
    rows_ = [("a", [1.0, 2.0]), ("b", [1.0, 2.0, 3.0, 4.0])]
    mixed = spark.createDataFrame(rows_, "id string, embedding array<float>").coalesce(1)
    query = spark.createDataFrame([("q", [1.0, 2.0])], "qid string, qv array<double>")
    with pytest.raises(Exception, match="vectors have 2 to 4 numbers"):
        nearest(query, mixed).collect()


def test_long_vectors_keep_l2_exact(spark):
    rng = np.random.default_rng(1)
    v = 1e6 + rng.normal(size=(300, 4)) * 1e-2
    ids = [f"r{n:03d}" for n in range(300)]
    items = spark.createDataFrame(list(zip(ids, v.tolist())), "id string, embedding array<double>")
    query = spark.createDataFrame([("q", v[17].tolist())], "qid string, qv array<double>")
    got = [r["id"] for r in nearest(query, items, 20, "l2").orderBy("rk").collect()]
    gaps = np.sqrt(((v - v[17]) ** 2).sum(1))
    assert got == [ids[n] for n in np.argsort(np.round(gaps, 9), kind="stable")[:20]]


def test_bad_arguments(frames):
    with pytest.raises(ValueError, match="metric"):
        nearest(*frames, metric="dot")
    with pytest.raises(ValueError, match="k is"):
        nearest(*frames, k=0)


def test_no_queries_and_no_match(frames):
    queries, items = frames
    assert exact_search(queries.where("false"), items).count() == 0
    assert exact_search(queries, items, where="title = 'none'").count() == 0


def test_filter_comes_before_the_limit(data, frames):
    queries, items = frames
    hits = exact_search(queries, items, where=F.col("title") == "t 2")
    qids, q, ids, v = data
    allowed = np.tile(np.arange(len(ids)) % 4 == 2, (len(qids), 1))
    assert rows(hits) == brute(qids, q, ids, v, 5, "cosine", allowed)
    row = hits.first()
    assert (row["url"], row["text"]) == (f"u/{row['id']}", f"text {row['id']}")


def test_large_hit_sets_join_by_shuffle(data, frames):
    assert rows(exact_search(*frames, small_rows=1)) == brute(*data, 5, "cosine")


def test_one_query(frames, data):
    queries, items = frames
    hits = single_query_search(queries.where("qid = 'q3'"), items)
    assert rows(hits) == [r for r in brute(*data, 5, "cosine") if r[0] == "q3"]
    with pytest.raises(ValueError):
        single_query_search(queries, items)


def lloyd(ids, v, nlist, iters, metric="cosine"):
    order = sorted(range(len(ids)), key=lambda n: (hashlib.md5(ids[n].encode()).hexdigest(), ids[n]))
    c = v[order[:nlist]]
    for _ in range(iters):
        near = assign(v, c, metric)
        c = np.array([v[near == j].mean(0) if (near == j).any() else c[j] for j in range(nlist)])
    return c


def assign(v, c, metric="cosine"):
    s = score_all(v, c, metric)
    return np.argmin(s, axis=1) if metric == "l2" else np.argmax(s, axis=1)


@pytest.fixture(scope="module")
def trained(frames):
    return I.train_centroids(frames[1], nlist=9, iters=3).cache()


def centers(df):
    return np.array([r["c"] for r in df.orderBy("cid").collect()])


def test_lloyd(data, frames, trained):
    want = lloyd(data[2], data[3], 9, 3)
    assert centers(trained) == pytest.approx(want)
    large = I.train_centroids(frames[1], nlist=9, iters=3, small_rows=2)
    assert centers(large) == pytest.approx(want)


def test_lloyd_l2(data, frames):
    got = I.train_centroids(frames[1], nlist=5, iters=2, metric="l2")
    assert centers(got) == pytest.approx(lloyd(data[2], data[3], 5, 2, "l2"))


def test_buckets(data, frames, trained):
    near = assign(data[3], centers(trained))
    want = dict(zip(data[2], near))
    for small_rows in (1000, 2):
        placed = I.assign_buckets(frames[1], trained, small_rows=small_rows)
        assert {r["id"]: r["cid"] for r in placed.collect()} == want
    sizes = {r["cid"]: r["n"] for r in I.bucket_sizes(placed).collect()}
    assert sizes == {c: n for c, n in enumerate(np.bincount(near, minlength=9)) if n}


def test_mllib_centroids(frames):
    got = I.train_centroids(frames[1], nlist=4, iters=5, method="mllib")
    assert got.count() == 4 and len(got.first()["c"]) == DIM
    with pytest.raises(ValueError):
        I.train_centroids(frames[1], method="other")


@pytest.mark.parametrize("small_rows", [10_000, 1])
@pytest.mark.parametrize("nprobe", [1, 3, 9])
def test_ivf_scans_the_probed_buckets_only(data, frames, trained, nprobe, small_rows):
    qids, q, ids, v = data
    c = centers(trained)
    placed = I.assign_buckets(frames[1], trained)
    hits = rows(ivf_search(frames[0], placed, trained, nprobe=nprobe, small_rows=small_rows))
    probed = np.argsort(-score_all(q, c, "cosine"), axis=1, kind="stable")[:, :nprobe]
    near = assign(v, c)
    allowed = np.array([np.isin(near, p) for p in probed])
    assert hits == brute(qids, q, ids, v, 5, "cosine", allowed)
    if nprobe == 9:
        assert hits == rows(exact_search(*frames))


def test_recall_grows_with_nprobe(frames, trained):
    placed = I.assign_buckets(frames[1], trained).cache()
    exact = exact_search(*frames, fields=[])
    found = [
        recall_at_k(exact, ivf_search(frames[0], placed, trained, nprobe=n, fields=[])).first()
        for n in (1, 3, 9)
    ]
    recalls = [r["recall"] for r in found]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0
    assert found[0]["expected"] == 50 and found[0]["queries"] == 10


def test_stored_buckets_are_pruned(spark, frames, trained, tmp_path):
    from passagelake.sources.tables import create_collection, load_collection

    placed = I.assign_buckets(frames[1], trained)
    target = create_collection(placed, str(tmp_path / "c"), DIM)
    stored = load_collection(spark, target)
    hits = ivf_search(frames[0].where("qid = 'q2'"), stored, trained, nprobe=2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [cid") >= 2 or plan.count("cid#") and "PartitionFilters: []" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert rows(hits) == rows(ivf_search(frames[0].where("qid = 'q2'"), placed, trained, nprobe=2))


def test_stats(frames, trained):
    placed = I.assign_buckets(frames[1], trained)
    assert tuple(I.collection_stats(placed).first()) == (700, DIM, 9, 700 * DIM * 4)
    assert I.collection_stats(frames[1]).first()["nlist"] == 0
    assert (I.suggested_nlist(10_000), I.suggested_nlist(100_000_000)) == (100, 40_000)


def test_encoders_must_match(frames):
    queries, items = frames
    marked = queries.withColumn("qv", F.col("qv").alias("qv", metadata={"encoder_id": "a"}))
    other = items.withColumn("embedding", F.col("embedding").alias("e", metadata={"encoder_id": "b"}))
    with pytest.raises(ValueError, match="encoded by"):
        exact_search(marked, other)


def test_presentation(spark):
    hits = spark.createDataFrame(
        [(1, 2, "b", 0.5, "x\ny", "u", "t"), (1, 1, "a", 0.61234, None, None, None)],
        "qid int, rk int, id string, score double, text string, url string, title string",
    )
    shown = [tuple(r) for r in described_hits(hits).orderBy("rk").collect()]
    assert shown == [
        (1, 1, "a", "#1", "+0.6123", "good", "", "", ""),
        (1, 2, "b", "#2", "+0.5000", "fair", "t", "u", "x y"),
    ]
    nested = as_nested_hits(hits).first()["hits"]
    assert [h["id"] for h in nested] == ["a", "b"]
    assert nested[0]["entity"]["text"] == "" and nested[1]["distance"] == 0.5
