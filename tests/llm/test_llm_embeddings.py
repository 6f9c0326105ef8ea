"""Approximate search and hard negatives against brute force."""

import math

import numpy as np
import pytest

from conftest import rows_of
from passagelake.llm import hard_negatives as mining
from passagelake.llm import projection_forest as forests
from passagelake.llm.queries import LLM_QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score string, leaf long, anchor string"


def vectors_of(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def edge_vectors(n=900, width=8):
    chooser = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(chooser.normal(size=width))], int(chooser.integers(4))) for i in range(n)]
    same = rows[17][1]
    rows += [(2000 + i, same, i % 3) for i in range(700)]  # a third are copies of one vector
    rows += [(3000, None, 1), (3001, [1.0] * (width - 1) + [None], 1), (3002, [math.nan] * width, 1), (3003, [0.0] * width, 1)]
    rows += [(3004, [math.inf] + [1.0] * (width - 1), 2), (3005, rows[5][1], None), (None, rows[6][1], 1)]
    rows += [rows[20], rows[40], (40, rows[41][1], rows[41][2]), rows[100]]  # repeated ids
    return rows


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 1, "own", 2, "own") for r in rows], schema).repartition(5)


def exact_nearest(rows, k=20, every=20):
    """{query: [(score, id)]}, the best pair of each two ids."""
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and sound(v) and any(v)]
    ids, matrix = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    out = {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        best = {}
        for v in matrix[ids == q]:
            for i, s in zip(ids.tolist(), (matrix * v).sum(axis=1).tolist(), strict=True):
                if i != q:
                    best[i] = max(best.get(i, -math.inf), s)
        out[q] = sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k]
    return out


def check_hits(found, rows, want, recall):
    vectors = {}
    for i, v, _ in rows:
        if i is not None and sound(v):
            vectors.setdefault(i, []).append(np.array(v, float))
    hits = {}
    for r in found.collect():
        hits.setdefault(r.query_id, []).append(r)
    assert hits.keys() == want.keys()
    right = total = 0
    for q, mine in hits.items():
        mine.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(want[q]) + 1))
        assert len({r.vec_id for r in mine}) == len(mine) and q not in {r.vec_id for r in mine}
        assert mine == sorted(mine, key=lambda r: (-r.score, r.vec_id))
        for r in mine:
            best = max(float((a * b).sum()) for a in vectors[q] for b in vectors[r.vec_id])
            assert r.score == pytest.approx(best, abs=1e-12)
        right += len({r.vec_id for r in mine} & {i for _, i in want[q]})
        total += len(want[q])
    assert right >= recall * total, right / total


@pytest.mark.parametrize("options", [{"leaf_rows": 5000}, {}, {"leaf_rows": 20}, {"leaf_rows": 60, "trees": 2, "recall": 0.99}])
def test_search_of_edge_cases(spark, options):
    rows = edge_vectors()
    want = exact_nearest(rows)
    check_hits(forests.search(table(spark, rows), F.col("vec_id") % 20 == 0, **options), rows, want, 1.0 if options.get("leaf_rows") == 5000 else 0.9)


def test_search_in_small_tiles(spark, monkeypatch):
    """Split leaves, several tiles of queries, blocks of few scores."""
    for name, value in (("TILE_ROWS", 50), ("TILE_QUERIES", 30), ("BLOCK_SCORES", 500)):
        monkeypatch.setattr(forests, name, value)
    rows = edge_vectors()
    found = forests.search(table(spark, rows), F.col("vec_id") % 20 == 0, leaf_rows=100)
    check_hits(found, rows, exact_nearest(rows), 0.9)


def test_search_recall_of_a_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = vectors_of(spark, folder)
    check_hits(LLM_QUERIES["op12_projection_forest"](spark, folder), rows, exact_nearest(rows), 0.93)


def test_search_without_rows_or_with_few(spark):
    assert forests.search(table(spark, [(3, None, 1)]), F.lit(True)).count() == 0
    few = [(20, [1.0, 0.0], 1), (21, [1.0, 1.0], 1), (22, [-1.0, 0.0], 1)]
    got = rows_of(forests.search(table(spark, few), F.col("vec_id") % 20 == 0), "query_id", "rank", "vec_id", "score")
    assert got == [(20, 1, 21, 1.0), (20, 2, 22, -1.0)]
    with pytest.raises(Exception, match="components"):
        forests.search(table(spark, [*few, (23, [1.0], 1)]), F.lit(True)).collect()


def test_forest_has_every_row_in_every_tree():
    vectors = np.random.default_rng(1).normal(size=(4000, 16))
    forest = forests.fit(vectors[:2000], 3, 4)
    leaves = forest.leaves_of(vectors)
    assert leaves.shape == (4000, 3) and leaves.min() == 0 and leaves.max() == 15
    for tree in range(3):
        assert np.bincount(leaves[:2000, tree], minlength=16).max() <= 126
    # Opening all leaves finds all; the queue's order is that of the distances.
    margins = forest.margins(vectors[:5])
    for m in margins:
        order = forest.visit(m.tolist(), 48, [1] * 48, 0)
        far = forest.distances(m).reshape(-1)
        assert sorted(order) == list(range(48)) and (np.diff(far[order]) >= 0).all()
    curve = forests.recall_curve(forest, vectors[:2000], np.arange(50), 10)
    assert curve[-1] == 1 and (np.diff(curve) >= 0).all()


def test_visits_go_on_until_enough_rows_are_held():
    forest = forests.fit(np.random.default_rng(1).normal(size=(500, 4)), 2, 3)
    margins = forest.margins(np.ones((1, 4)))[0].tolist()
    assert len(forest.visit(margins, 1, [3] * 16, 7)) >= 3
    assert len(forest.visit(margins, 1, [0] * 16, 7)) == 16


# --- hard negatives ----------------------------------------------------------------


def exact_negatives(rows, anchors=100, moved=True, positives=5, negatives=10):
    good = []
    for i, v, label in rows:
        if i is None or label is None or not sound(v):
            continue
        label = (label + 1) % 10 if moved and i % 7 == 0 else label
        good.append((i, label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a, label, v in sorted({g for g in good if g[0] % anchors == 0}):
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), i, k) for i, k, w in good if len(w) == len(v)]
        same = sorted(((s, i) for s, i, k in scored if k == label and i != a), key=lambda x: (-x[0], x[1]))[:positives]
        other = sorted(((s, i) for s, i, k in scored if k != label), key=lambda x: (-x[0], x[1]))
        for p, pid in same:
            window = [(s, i) for s, i in other if 30 * p <= 100 * s <= 90 * p][:negatives]
            out += [(a, pid, n, i, p, s) for n, (s, i) in enumerate(window, 1)]
    return sorted(out, key=repr)


MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:  # tiles on both sides, blocks of few scores
        for name, value in (("SMALL_ANCHORS", 3), ("TILE", 40), ("BLOCK_SCORES", 100)):
            monkeypatch.setattr(mining, name, value)
    rows = edge_vectors() + [(5000, [0.0] * 8, 2), (4000, [0.5] * 5, 2), (4001, [0.5] * 5, 2), (4002, [0.4] * 5, 1), (4100, [], 1), (4101, [], 2)]
    df = table(spark, rows).withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    found = mining.hard_negatives(df, F.col("vec_id") % 100 == 0)
    want = exact_negatives(rows)
    assert len(want) > 500 and {r[5] for r in want if r[0] == 5000} == {0}
    assert rows_of(found, *MINED) == want


def test_hard_negatives_of_a_table(spark):
    folder = "/root/testdata/sf0.1"
    assert rows_of(LLM_QUERIES["op13_hard_negatives"](spark, folder), *MINED) == exact_negatives(vectors_of(spark, folder))


def test_hard_negatives_of_nothing(spark):
    assert mining.hard_negatives(table(spark, []), F.lit(True)).count() == 0
    assert mining.hard_negatives(table(spark, [(100, None, 1), (100, [1.0], None)]), F.lit(True)).count() == 0
    alone = [(100, [1.0], 1), (101, [1.0], 2)]
    assert mining.hard_negatives(table(spark, alone), F.col("vec_id") == 100).count() == 0


def test_keys_sort_like_what_they_hold(spark):
    chooser = np.random.default_rng(2)
    edge = [0, 1, -1, 2**63 - 1, -(2**63)]
    rows = [(a, s, k, i) for a in (-3, 0, 2**62) for s in (*edge, *chooser.integers(-9, 9, 4).tolist()) for k in (0, 1) for i in edge]
    df = spark.createDataFrame(rows, "a long, s long, k int, i long")
    keys = [r[0] for r in df.select(mining.packed(*map(F.col, "aski")).alias("key")).orderBy("key").collect()]
    got = [mining.unpacked(bytes(k)) for k in keys]
    assert got == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


def test_windows_stream():
    """Ties, zero and negative positives, windows that fill and close at different scores."""
    rows = [(1, 100, 0, 5), (1, 100, 0, 6), (1, 95, 1, 1), (1, 90, 1, 9), (1, 89, 1, 2), (1, 40, 0, 7), (1, 36, 1, 3), (1, 30, 1, 4), (1, 29, 1, 8)]
    rows += [(2, 0, 0, 9), (2, 0, 1, 3), (2, -1, 0, 4), (2, -1, 1, 5)]
    pack = lambda a, s, k, i: __import__("struct").pack(mining.KEY, a + mining.SIGN, ~s + mining.SIGN, k, i + mining.SIGN)
    got = list(mining.mined([pack(*r) for r in rows], 2, 30, 90))
    assert [r[:5] for r in got] == [
        (1, 5, 1, 9, 100), (1, 6, 1, 9, 100), (1, 5, 2, 2, 100), (1, 6, 2, 2, 100), (1, 7, 1, 3, 40), (1, 7, 2, 4, 40), (2, 9, 1, 3, 0),
    ]


def test_large_numbers_stay_exact_or_are_refused():
    a = np.array([[2.0**25, 3.0]])
    assert mining.exact_products(a, np.array([[2.0**26, 5.0]])).tolist() == [[2**51 + 15]]
    with pytest.raises(ValueError, match="2\\*\\*53"):
        mining.exact_products(a, np.array([[2.0**40, 5.0]]))
