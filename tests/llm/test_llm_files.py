"""Token files, WARC archives, URL rules, mixing and the pipeline."""

import gzip
import hashlib
import io
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SCHEMA, edge_texts, prose, rows_of
from test_llm_dedup import brute_fingerprint, reachable
from passagelake.llm import mixing, token_files, url_filter, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("by_words", [True, False])
def test_token_roundtrip(documents, nothing, by_words):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = edge_texts()
    found = token_files.token_roundtrip(documents, TOKENIZER, 1, by_words, width=2)
    got = found.orderBy("start").collect()
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is None, i or 0))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    assert token_files.token_roundtrip(nothing, TOKENIZER, 1, by_words).count() == 0


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def token_file(width=4, n=400):
    out = io.BytesIO()
    file = token_files.TokenFile(out, width)
    counts = np.random.default_rng(1).integers(1, 2000, n)
    tokens = np.random.default_rng(2).integers(0, 60_000, counts.sum()).astype("<u4")
    file.add([None if i == 7 else i * 3 for i in range(n)], tokens, counts)
    assert file.close() == (n, counts.sum())
    return out.getvalue(), tokens, counts


@pytest.mark.parametrize("width", [2, 4])
def test_readers_decompress_only_what_they_need(width):
    data, tokens, counts = token_file(width)
    reader = token_files.TokenReader(Source(data))
    assert reader.null.tolist() == [i == 7 for i in range(400)] and reader.doc_ids[9] == 27
    start = counts[:200].sum()
    ids = np.concatenate(list(reader.parts(200)))
    assert (ids == tokens[start : start + counts[200]]).all() and reader.frames_read <= 2
    # Any zstandard reader can read the whole file, as what isn't data is skippable.
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole == tokens.astype(f"<u{width}").tobytes()


def test_a_damaged_frame_is_found():
    data, _, _ = token_file()
    damaged = bytearray(data)
    damaged[len(data) // 3] ^= 255
    reader = token_files.TokenReader(Source(bytes(damaged)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        for i in range(400):
            list(reader.parts(i))


def test_words_of_another_tokenizer():
    """Without the known shape of normaliser and pattern, words are encoded whole."""
    encode = token_files.Encoder(TOKENIZER, 1, True)
    plain = token_files.Encoder(TOKENIZER, 1, True)
    plain.pattern, plain.known = None, {}
    texts = pa.array([prose(9, 300) + " it's 'Twas x_y 12ab", None, "naïve café"])
    for a, b in zip(encode(texts), plain(texts), strict=True):
        assert (a == b).all()


def test_encoding_holds_little_besides_the_ids():
    """Some twenty bytes a word, of which four are returned."""
    encode, n = token_files.Encoder(TOKENIZER, 1, True), 1 << 20
    texts = pa.array(["ab cd " * (n // 8)] * 4)
    want, counts = encode(texts)
    tracemalloc.start()
    got = encode(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got[0] == want).all() and counts.tolist() == [n // 4 + 1] * 4
    assert most < 28 * n


def test_words_that_come_again_are_not_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    encode, asked = token_files.Encoder(TOKENIZER, 1, True), []
    encode.known, encode.earlier, encode.pattern = {}, {}, None  # whole words go to the tokenizer
    encoded = encode._encoded
    encode._encoded = lambda words: asked.extend(words) or encoded(words)
    for i in range(20):
        encode(pa.array(["often " + " ".join(f"w{i}x{k}" for k in range(30))]))
        assert len(encode.known) + len(encode.earlier) <= 2 * (50 + 31)
    assert asked.count("often") == 1 and len(asked) == 20 * 30 + 1


def test_a_worker_carries_few_words_from_task_to_task(tmp_path, monkeypatch):
    context = SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 0)
    monkeypatch.setattr(token_files, "TaskContext", SimpleNamespace(get=lambda: context))
    monkeypatch.setattr(token_files, "CARRIED", 100, raising=False)
    encode = token_files.Encoder(TOKENIZER, 1, True)
    for held in (encode.known, encode.earlier, encode.pieces, encode.earlier_pieces):
        held.clear()
    texts = pa.array(["often " + " ".join(f"q{k}x{k}" for k in range(5_000))])
    want = encode(texts)
    write = token_files._writer(str(tmp_path), TOKENIZER, 1, True, 2)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), texts], names=["doc_id", "text"])
    assert [b["tokens"].to_pylist() for b in write(iter([batch]))] == [want[1].tolist()]
    assert 0 < len(encode.known) + len(encode.earlier) <= 100 >= len(encode.pieces) + len(encode.earlier_pieces) > 0
    assert b"often" in encode.earlier and all((a == b).all() for a, b in zip(encode(texts), want, strict=True))


PAGES = "page_id long, url string, html string, digest string, size long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "own", 1) for i, u, h in rows], PAGES).repartition(3)


def test_warc_roundtrip(spark):
    long, other = "<p>é " * 60, "x" * 100
    rows = [
        (4, "http://a/1", long), (2, "http://a/2", long), (9, None, long), (3, "http://b c/\r\nX: 1", other),
        (8, "u", other), (5, "u", "short"), (6, "u", "short"), (7, "u", None), (10, "u", None), (11, "u", "y" * 300_000),
        (12, "u", "line\r\n\r\nWARC/1.1\r\n" * 20), (None, "u", long), (13, "u", "x" * 99), (14, "u", "x" * 99),
    ]
    found = warc.warc_roundtrip(pages(spark, rows))
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        same = [k for k, _, g in rows if k is not None and (g or "").encode() == body]
        first = min(same) if len(body) >= 100 and i is not None and min(same) != i else None
        kind = "response" if first is None else "revisit"
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), kind, first))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows_of(found, *columns) == sorted(want, key=repr)
    assert warc.warc_roundtrip(pages(spark, []).limit(0)).count() == 0


def test_warc_files_hold_each_payload_once(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "z" * 1000) for i in range(50)]
    files = warc.write_archives(pages(spark, rows), str(tmp_path / "w")).collect()
    assert sum(f.records for f in files) == 50
    text = b"".join(gzip.open(f.path).read() for f in files)
    assert text.count(b"z" * 1000) == 1 and text.count(b"WARC-Type: revisit") == 49
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == sorted(f.path.split("/")[-1] for f in files)


def test_records_are_read_alone():
    record = warc.warc_record(3, "http://x/", b"abc\r\n\r\n", "d", None)
    fields = warc.parse_record(gzip.decompress(record))
    assert fields["payload"] == b"abc\r\n\r\n" and fields["WARC-Type"] == "response"


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def expected_verdict(url, rules, default):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


URLS = [
    None, "", "example.net/en/", "http://example.net/en/1", "HTTP://EXAMPLE.NET/en", "http://a.example.net/de/", "https://net/",
    "http://net", "http://net?x=/", "http://xnet/", "http://notexample.com/de/", "http://b.example.com/de/x?y#z",
    "http://example.com/DE/", "http://é.ORG/fr/ä", "http://x.org/fr", "http://x.org#/fr/", "http://u@example.com:80/de/",
    "http://a\nb.net/x\ny", "x://y://net/", "http:///en/", "http://.net/", "http://a..net//",
]


def test_url_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 2)] + [(None, "http://net/")]
    table = spark.createDataFrame([(i, u, "own", "own") for i, u in rows], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(((i, *expected_verdict(u, RULES, "allow")) for i, u in rows), key=repr)
    assert rows_of(url_filter.filter_urls(table, rules), *columns) == want
    none = rules.limit(0)
    assert {r.verdict for r in url_filter.filter_urls(table, none, "block").collect()} == {"block"}
    assert url_filter.filter_urls(table.limit(0), rules).count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_url_rules_from_a_long_list(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(url_filter, "SMALL_RULES", 10)
    rules = [(f"h{i}.example", f"/p{j}/", ("block", "allow")[(i + j) % 2]) for i in range(40) for j in range(5)]
    rules += [(f"h{i}.example", "", "block") for i in range(0, 40, 3)] + [(None, "/", "block"), ("h1.example", None, "block")]
    real = [r for r in rules if None not in r]
    urls = [f"http://www.h{i}.example/p{j}/x" for i in range(60) for j in range(7)]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    df = spark.createDataFrame(rules, "host string, path string, verdict string")
    want = sorted(((i, *expected_verdict(u, real, "allow")) for i, u in enumerate(urls)), key=repr)
    assert rows_of(url_filter.filter_urls(table, df), "page_id", "host", "path", "rule", "verdict") == want


def test_the_filter_has_no_false_negative(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom = url_filter.blocked_bloom(keys, 1500)
    assert url_filter._passed(keys, bloom, 1500).count() == 3000
    others = spark.range(3000).select(F.concat(F.lit("o"), "id").alias("key"))
    assert url_filter._passed(others, bloom, 1500).count() < 200


def expected_targets(sizes):
    """By repeated sharing, as the contract says it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        whole, over = sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=repr):
            target[s] += left * weight[s] / whole
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                over += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
        left = over
    return target


def test_mixing(spark, documents, nothing):
    rows = [(i, prose(i, 20 + i % 50), ("s1", "s0", "Z", None, "é")[i % 5 if i < 400 else 0]) for i in range(600)]
    rows += [(900, "tiny", "lone"), (901, None, "empty"), (902, "", "s0"), (900, "tiny", "lone")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    first, again = (sorted(map(tuple, mixing.mix_sources(df).collect()), key=repr) for _ in range(2))
    assert first == again and len(first) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = expected_targets(sizes), defaultdict(int)
    for i, source, size, source_size, target, took in first:
        assert source_size == sizes[source] and target == pytest.approx(want[source]) and 0 <= took <= 3 * size
        taken[source] += took
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 4)
    assert mixing.mix_sources(nothing).count() == 0
    assert mixing.mix_sources(documents).count() == documents.count()


def test_schedule_is_even_everywhere(spark):
    targets = spark.createDataFrame([(0, 500.0), (1, 250.0), (2, 250.0), (3, 0.0)], "number int, target double")
    slots = mixing.schedule(targets, 1000)
    got = {r.number: r for r in slots.groupBy("number").agg(F.count("*").alias("n"), F.max("block").alias("m")).collect()}
    assert {k: r.n for k, r in got.items()}.keys() == {0, 1, 2}
    assert abs(got[0].n - 500) <= 3 and abs(got[1].n - 250) <= 3
    assert all(r.m == r.n - 1 for r in got.values())


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    item = prose(70, 40)
    rows = [(i, prose(200 + i, 60 + i % 40), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100, rows[3][1], "en", "s0", 0), (101, rows[4][1].upper(), "en", "s1", 0), (102, None, "en", "s0", 0)]
    rows += [(103, "12 34 ++", "en", None, 0), (104, prose(80, 30) + " " + item + " " + prose(81, 30), "en", "s2", 0)]
    docs = spark.createDataFrame([(*r, 0.5, "own") for r in rows], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    (_, language), (_, near), (_, clean), (_, mix), (_, tokens) = corpus_pipeline.STAGES
    read, sf = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)

    def ids(df):
        assert df.columns == docs.columns
        return Counter(r.doc_id for r in df.select("doc_id").collect())

    every = Counter(r[0] for r in rows)
    assert ids(language(spark, read, sf)) == every - Counter([102, 103])
    assert ids(near(spark, read, sf)) == every - Counter([100, 101])
    assert ids(clean(spark, read, sf)) == every - Counter([104])
    mixed = mix(spark, read, sf)
    assert set(ids(mixed)) <= set(every) - {102} and max(ids(mixed).values()) <= 3
    assert corpus_pipeline.run(spark, sf).count() > 40
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, read.limit(0), sf).count() == 0


def stays(rows):
    """Per group of linked fingerprints, the smallest doc_id (None last) and its text."""
    prints = [brute_fingerprint(t) for _, t in rows]
    label = reachable(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    kept = {}
    for (i, t), group in zip(rows, label, strict=True):
        kept[group] = min(kept.get(group, (True, 0)), (i is None, i or 0))
    return Counter(None if none else i for none, i in kept.values())


def test_near_duplicate_stage_against_brute_force(spark, tmp_path):
    """Families of copies at all distances, originals of any id, short and blank texts."""
    import corpus_pipeline

    chooser, texts = random.Random(8), []
    for family in range(25):
        base = prose(1000 + family, 150).split()
        texts += [" ".join(base), " ".join(base).upper(), "\n".join(base)]
        for k in range(6):
            w = list(base)
            for s in range(k // 2 + 1):
                w[chooser.randrange(len(w))] = f"x{family}k{k}s{s}"
            texts.append(" ".join(w))
    texts += ["a b c", "A  b c", "a b", "", None, prose(1, 5), prose(1, 6)]
    ids = chooser.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    want = stays(rows)
    assert 40 < sum(want.values()) < len(rows) - 50
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 0.5, "own") for i, t in rows], SCHEMA)
    kept = corpus_pipeline.STAGES[1][1](spark, docs.repartition(3), str(tmp_path))
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == want


def test_rows_without_an_id_of_their_own(spark, tmp_path):
    """Null and repeated ids: rows are told apart by their texts, in every stage that drops or repeats rows."""
    import corpus_pipeline

    a, b, c, d = (prose(300 + k, 80) for k in range(4))
    item = prose(70, 40)
    rows = [(None, a), (None, a.upper()), (None, b), (None, c + " " + item), (3, b.lower()), (None, c)]
    rows += [(7, d), (7, d.upper()), (7, a[:40]), (7, d), (7, a[:40] + " " + item)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 0.5, "own") for i, t in rows], SCHEMA)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = stages[1](spark, docs, str(tmp_path))
    assert Counter(r.doc_id for r in kept.collect()) == stays(rows)
    clean = stages[2](spark, docs, str(tmp_path))
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r in rows if item not in r[1])
    mixed = Counter((r.doc_id, r.text) for r in stages[3](spark, docs, str(tmp_path)).collect())
    assert set(mixed) <= set(rows) and all(mixed[r] <= 3 * n for r, n in Counter(rows).items())
    assert abs(sum(len(t.split()) * n for (_, t), n in mixed.items()) - sum(len(t.split()) for _, t in rows)) < 200


def test_language_stage_rejects_what_no_language_explains(spark, tmp_path):
    import corpus_pipeline

    chooser = random.Random(2)
    junk = "".join(chooser.choice("\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b") for _ in range(400))
    rows = [(i, prose(i, 80), "en", "s", 0, 0.5, "own") for i in range(60)]
    rows += [(100, junk, None, "s", 0, 0.5, "own"), (101, prose(3, 60) + " " + junk[:20], None, "s", 0, 0.5, "own")]
    rows += [(102, "12 ++", "en", "s", 0, 0.5, "own"), (None, prose(4, 50), None, "s", 0, 0.5, "own")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*range(60), 101, None])
