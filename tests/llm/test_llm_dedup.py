"""Exact, substring and near-duplicate operators against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from conftest import edge_texts, prose, rows_of
from passagelake.llm import exact_dedup, simhash, substring_dedup
from passagelake.llm.common import components

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")


def expected_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(BLANK)].append((i, len(t or "")))
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, digest) for i, _ in members]
    return sorted(out, key=repr)


def test_exact_dedup(documents, nothing):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(exact_dedup.exact_dedup(documents), *columns) == expected_exact(edge_texts())
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_directory_splits_full_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key")).distinct()
    slots, depth = exact_dedup.directory(keys, 100)
    slots = slots.toPandas()
    assert depth >= 6 and slots["local_depth"].max() == depth
    top = keys.select(exact_dedup._top("key", depth).alias("slot")).toPandas()["slot"]
    filled = top.map(slots.set_index("slot")["bucket"]).value_counts()
    assert filled.max() <= 100 and filled.sum() == 5000
    # A bucket above the others' depth is held by all slots that share its bits.
    for bucket, some in slots.groupby("bucket"):
        assert some["local_depth"].nunique() == 1
        assert len(set(some["slot"] >> (depth - some["local_depth"].iloc[0]))) == 1


def test_chained_collisions(spark, monkeypatch):
    """With all keys equal, entries are told apart by their bytes."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *a: F.lit(7).cast("long"))
    rows = [(1, "a b"), (2, "ab"), (3, "c"), (4, "d"), (5, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(exact_dedup.exact_dedup(df), *columns) == expected_exact(rows)


def expected_substring(rows):
    worded = [(float("inf") if i is None else i, i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, _, w in worded:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, shown, w in worded:
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((shown, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup(spark, documents, nothing):
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    found = rows_of(substring_dedup.substring_dedup(documents), *columns)
    assert found == expected_substring(edge_texts())
    assert sum(r[2] for r in found) > 300
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_substring_dedup_at_every_alignment(spark):
    """Passages of just over and under a window, shifted against each other, many blocks."""
    chooser, rows = random.Random(4), []
    parts = [prose(100 + k, n).split() for k, n in enumerate((12, 13, 14, 30, 61))]
    for i in range(120):
        words = []
        for _ in range(6):
            words += prose(chooser.randrange(10**6), chooser.randrange(12)).split() + chooser.choice(parts)
        rows.append((i * 97, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    result = substring_dedup.substring_dedup(df, with_text=True)
    assert rows_of(result, "doc_id", "n_words", "n_removed", "kept_sha256") == expected_substring(rows)
    for r in result.collect():
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(n):
                if label[b] < label[a] and linked(a, b):
                    label[a], changed = label[b], True
    return label


def test_near_duplicates(documents, nothing):
    rows = edge_texts()
    prints = [brute_fingerprint(t) for _, t in rows]
    label = reachable(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    least = {}
    for (i, _), group in zip(rows, label, strict=True):
        if i is not None:
            least[group] = min(least.get(group, i), i)
    want = sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, label, strict=True)), key=repr)
    found = simhash.near_duplicates(documents).select("doc_id", simhash.hex_fingerprint().alias("fp"), "component_id")
    assert rows_of(found, "doc_id", "fp", "component_id") == want
    assert simhash.near_duplicates(nothing).count() == 0


def test_links_connect_all_pairs_within_the_radius(spark):
    chooser = np.random.default_rng(5)
    centres = chooser.integers(-(2**62), 2**62, 30)
    prints = {int(c) ^ sum(1 << int(b) for b in chooser.choice(63, k, replace=False)) for c in centres for k in (0, 1, 1, 2, 3)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(df)).collect()}
    label = reachable(len(prints), lambda a, b: ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 2)
    got = Counter(roots.get(p, p) for p in prints)
    assert sorted(got.values()) == sorted(Counter(label).values())


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = list(zip(order, order[1:])) + [(500, 501), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect() if r.node < 500 and r.node} == {i: 0 for i in range(1, 200)}
    assert {r.root for r in found.where("node = 501").collect()} == {500}


def test_the_index_decides(spark, documents, monkeypatch):
    """Rows reach their entry through directory and bucket only; many buckets, folds and chains."""
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = [(i, prose(i % 40, 6) + " " * (i % 5)) for i in range(400)] + [(None, prose(3, 6)), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(exact_dedup.exact_dedup(df, bucket_keys=3), *columns) == expected_exact(rows)
    prints = exact_dedup._keyed(df).select("doc_id", "key", F.unhex(F.sha2("body", 256)).alias("sha"))
    index, slots, depth = exact_dedup.build_index(df, prints, 3)
    assert slots.select("bucket").distinct().count() > 5 and depth >= 3
    assert index.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 3
    # Without its directory the index is of no use.
    real = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda *a: (real(*a)[0].limit(0), real(*a)[1]))
    assert exact_dedup.exact_dedup(df, bucket_keys=3).count() == 0
