import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from passagelake import config
from passagelake.operators import prompts as P
from passagelake.operators.changes import carry_vectors, changes, text_digest
from passagelake.operators.two_level import TwoLevel
from passagelake.plans.stages import Chain, build_chunks, questions, search_text, stage_shares
from passagelake.sources import grouped, tables as S
from passagelake.streaming.ingest import first_of_slug, ingest_stream

TABLES = "/root/testdata/sf0.001"


@pytest.fixture
def hits(spark):
    return spark.createDataFrame(
        [(1, 2, "b", 0.5, " second ", "u2", "t2"), (1, 1, "a", 0.6, "first\nline", "u1", None)],
        "qid long, rk int, id string, score double, text string, url string, title string",
    )


@pytest.fixture
def asked(spark):
    return spark.createDataFrame([(1, "why?"), (2, "unknown?")], "qid long, qtext string")


def test_prompts(asked, hits):
    got = {r["qid"]: r["messages"] for r in P.build_prompts(asked, hits, "rules").collect()}
    assert got[2] is None
    assert [m["role"] for m in got[1]] == ["system", "user"]
    assert got[1][0]["content"] == "rules"
    assert got[1][1]["content"] == (
        "Context:\n[1] first\nline\n\n[2] second\n\nQuestion: why?\nAnswer:"
    )
    default = P.build_prompts(asked, hits).where("qid = 1").first()["messages"][0]["content"]
    assert default == config.system_prompt() and "{" not in default
    assert "for the Acme Cluster user documentation" in config.system_prompt("Acme Cluster")


def test_answers(asked, hits):
    def factory():
        return lambda chats: [f"  {len(chat)} messages\n" for chat in chats]

    answers = P.generate(P.build_prompts(asked, hits), factory)
    got = {r["qid"]: tuple(r)[1:] for r in P.answers_with_sources(answers, hits).collect()}
    assert got == {
        1: ("2 messages", "[1] \nu1\n[2] t2\nu2"),
        2: ("No relevant context found. Cannot answer.", ""),
    }
    sources = [tuple(r) for r in P.answer_sources(hits).orderBy("i").collect()]
    assert sources == [(1, 1, "", "u1"), (1, 2, "t2", "u2")]


def test_stage_shares(spark):
    timings = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "label string, elapsed double")
    got = {r["label"]: (r["percent"], len(r["bar"])) for r in stage_shares(timings).collect()}
    assert got == {"a": (25.0, 12), "b": (75.0, 37)}
    wall = {r["label"]: r["percent"] for r in stage_shares(timings, 8.0).collect()}
    assert wall == {"a": 12.5, "b": 37.5}
    assert {r["percent"] for r in stage_shares(timings, 0.0).collect()} == {0.0}


def test_clean_page_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    with pytest.raises(ValueError, match="Run the page step first"):
        S.read_clean_pages(spark, str(folder / "none"))
    with pytest.raises(ValueError, match="No pages found"):
        S.read_clean_pages(spark, str(folder))
    pages = {"a__b": {"url": "u1", "title": "t", "text": "é\nß"}, "c": {"url": "u2", "title": "", "text": ""}}
    for slug, page in pages.items():
        (folder / f"{slug}.json").write_text(json.dumps(page, ensure_ascii=False, indent=2), encoding="utf-8")
    got = S.read_clean_pages(spark, str(folder))
    assert {r["slug"]: {k: r[k] for k in ("url", "title", "text")} for r in got.collect()} == pages
    (folder / "x+y.json").write_text("{broken", encoding="utf-8")
    with pytest.raises(Exception, match="is not a JSON document"):
        S.read_clean_pages(spark, str(folder)).collect()
    got, broken = S.split_clean_pages(spark, str(folder))
    assert got.count() == 2 and [tuple(r) for r in broken.collect()] == [("x+y", "not a JSON document")]
    lines = S.write_clean_pages(got, str(tmp_path / "lines"))
    assert S.read_page_lines(spark, lines).exceptAll(got).isEmpty()
    written = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "lines").glob("*.json"))
    assert "é\\nß" in written


def rows(spark, *ids, text="x"):
    return spark.createDataFrame(
        [(i, "u", "t", text, [1.0, 2.0]) for i in ids],
        "id string, url string, title string, text string, embedding array<float>",
    )


@pytest.mark.parametrize("named", [False, True])
def test_collection_life(spark, tmp_path, named):
    target = "life_collection" if named else str(tmp_path / "c")
    with pytest.raises(ValueError, match="Run the index step first"):
        S.load_collection(spark, target)
    S.create_collection(rows(spark, "old"), target, 2)
    S.create_collection(rows(spark, "a", "b"), target, 2)
    S.insert_rows(rows(spark, "c").select("embedding", "text", "title", "url", "id"), target, 2)
    stored = S.load_collection(spark, target, keep_in_memory=True)
    assert {r["id"] for r in stored.collect()} == {"a", "b", "c"}
    stored.unpersist()
    with pytest.raises(ValueError):
        S.insert_rows(rows(spark, "d").drop("url"), target, 2)
    with pytest.raises(Exception, match="embedding_dim"):
        S.insert_rows(rows(spark, "d"), target, 3)
    for repeated in (rows(spark, "e", "e"), rows(spark, "a")):
        with pytest.raises(ValueError, match="repeated in the rows|already stored"):
            S.insert_rows(repeated, target, 2)
    with pytest.raises(ValueError, match="repeated in the rows"):
        S.create_collection(rows(spark, "e", "e"), target, 2)
    with pytest.raises(ValueError, match="the collection has"):
        S.upsert(S.read_table(spark, target).withColumn("cid", F.lit(1)), rows(spark, "b"))
    delivery = rows(spark, "b", "d", text="new").union(rows(spark, "d", text="early"))
    merged = S.upsert(S.read_table(spark, target), delivery)
    assert {r["id"]: r["text"] for r in merged.collect()} == {"a": "x", "b": "new", "c": "x", "d": "new"}
    if named:
        S.drop_collection(spark, target)
        assert not S.table_exists(spark, target)


def bucketed(spark, pairs, text="old"):
    return spark.createDataFrame(
        [(i, f"u{i}", "t", text, [1.0, float(c)], c) for i, c in pairs],
        "id string, url string, title string, text string, embedding array<float>, cid int",
    )


def centers(spark, n):
    return spark.createDataFrame([(c, [1.0, float(c)]) for c in range(n)], "cid int, c array<double>")


def folders(target):
    return {p.relative_to(target): p.stat().st_mtime_ns for p in target.glob("rows/*/*/*.parquet")}


def test_upsert_rewrites_touched_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(grouped, "packed", lambda sizes, *a: [c for c, _ in sorted(sizes)])  # a group a bucket
    target = str(tmp_path / "c")
    S.create_collection(bucketed(spark, [("a", 0), ("b", 1), ("c", 2), ("d", 2)]), target, 2)
    before = folders(tmp_path / "c")
    moved = bucketed(spark, [("b", 2), ("e", 2)], "new").drop("cid")
    with pytest.raises(ValueError, match="give rows with cid"):
        S.upsert_rows(moved, target, 2)
    S.upsert_rows(moved, target, 2, centers(spark, 3))
    got = {r["id"]: (r["text"], r["cid"]) for r in S.load_collection(spark, target).collect()}
    assert got == {"a": ("old", 0), "b": ("new", 2), "c": ("old", 2), "d": ("old", 2), "e": ("new", 2)}
    current = set(S.load_collection(spark, target).inputFiles())
    assert sum("version=1/grp=0" in f for f in current) == 1 and not any("version=1/grp=2" in f for f in current)
    assert before.items() <= folders(tmp_path / "c").items()  # what was there stays as it was
    assert grouped.drop_old_versions(spark, target) == 3
    assert {r["id"] for r in S.load_collection(spark, target).collect()} == set("abcde")
    S.insert_rows(bucketed(spark, [("f", 0)], "more"), target, 2)
    assert {r["id"] for r in S.load_collection(spark, target).collect()} == set("abcdef")
    for repeated in ("b", "f"):
        with pytest.raises(ValueError, match="already stored"):
            S.insert_rows(bucketed(spark, [("g", 0), (repeated, 1)]), target, 2)


def test_a_write_that_fails_leaves_the_collection(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "c")
    S.create_collection(bucketed(spark, [("a", 0), ("b", 1)]), target, 2)
    old = {tuple(r) for r in S.load_collection(spark, target).select("id", "text").collect()}

    def fails(*_):
        raise OSError("no longer there")

    for write in (S.upsert_rows, S.insert_rows, S.create_collection):
        with monkeypatch.context() as patch:
            patch.setattr(grouped, "_switch", fails)
            with pytest.raises(OSError):
                write(bucketed(spark, [("n", 1)], "new"), target, 2)
        assert {tuple(r) for r in S.load_collection(spark, target).select("id", "text").collect()} == old
    with pytest.raises(Exception, match="embedding_dim"):
        S.insert_rows(bucketed(spark, [("n", 1)], "new"), target, 3)
    # A manifest that is still being written doesn't count.
    (tmp_path / "c" / "manifests" / "9.draft").write_text("[[")
    assert S.load_collection(spark, target).count() == 2
    S.upsert_rows(bucketed(spark, [("a", 1)], "new"), target, 2)
    got = {r["id"]: (r["text"], r["cid"]) for r in S.load_collection(spark, target).collect()}
    assert got == {"a": ("new", 1), "b": ("old", 1)}


def test_inserts_of_new_keys_read_only_the_filters(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "c")
    S.create_collection(bucketed(spark, [(f"k{i}", i % 7) for i in range(3000)]), target, 2)
    read = []
    monkeypatch.setattr(grouped, "read", lambda *a, whole=grouped.read: read.append(a) or whole(*a))
    new = bucketed(spark, [(f"n{i}", i % 9) for i in range(500)])
    possible = grouped.possible_keys(new.select("id"), target)
    assert possible.count() <= 1
    assert grouped.possible_keys(S.load_collection(spark, target).select("id"), target).count() == 3000
    read.clear()
    assert grouped.stored_keys(new.select("id").where("id not in ('x')"), target).count() == 0
    assert len(read) == possible.count()
    S.insert_rows(new, target, 2)
    assert S.load_collection(spark, target).count() == 3500
    monkeypatch.setattr(grouped, "KEY_TABLES", 3)
    for n in range(2):  # tables of keys are put together now and then
        S.insert_rows(bucketed(spark, [(f"more{n}", n)]), target, 2)
    assert len([e for e in grouped._entries(spark, target) if e[0] == "keys"]) == 1
    for key in ("k5", "n499", "more1"):
        with pytest.raises(ValueError, match="already stored"):
            S.insert_rows(bucketed(spark, [(key, 0), ("fresh", 1)]), target, 2)


def test_many_buckets_lie_in_few_folders(spark, tmp_path):
    """10,000 buckets; a search for some of them reads their groups, and in these few rows."""
    target = str(tmp_path / "c")
    rows = spark.range(30_000).select(
        F.col("id").cast("string"), F.concat(F.lit("u"), "id").alias("url"), F.lit("t").alias("title"),
        F.lit("x").alias("text"), F.array(F.lit(1.0), F.col("id") % 10_000).cast("array<float>").alias("embedding"),
        (F.col("id") % 10_000).cast("int").alias("cid"),
    )
    S.create_collection(rows, target, 2)
    assert 10 <= len(list((tmp_path / "c" / "rows" / "version=1").glob("grp=*"))) <= 200
    stored = S.load_collection(spark, target)
    asked = grouped.in_groups(stored, [17, 9_999]).where(F.col("cid").isin(17, 9_999))
    assert asked.count() == 6
    plan = asked._jdf.queryExecution().executedPlan().toString()
    partition = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "grp" in partition and "cid" in plan.split("PushedFilters: [")[1].split("]")[0]
    read = [m for m in grouped.groups_of([17, 9_999], stored.schema["grp"].metadata["firsts"])]
    assert len(read) == 2
    assert stored.groupBy("cid").count().where("count <> 3").count() == 0


def test_groups_are_even():
    assert grouped.packed([(0, 5), (1, 5), (2, 5)], least=10) == [0, 2]
    assert grouped.packed([], least=10) == [0]
    firsts = grouped.packed([(c, 1000) for c in range(5000)])
    assert len(firsts) <= grouped.MAX_GROUPS
    assert grouped.groups_of([0, firsts[3], firsts[3] - 1, 10**6], firsts) == [0, 2, 3, len(firsts) - 1]
    # One bucket with most rows is a group of its own.
    assert grouped.packed([(0, 100), (1, 10**6), (2, 100)]) == [0, 1, 2]


def test_a_filter_on_url_skips_row_groups(spark, tmp_path):
    target = str(tmp_path / "c")
    rows = spark.range(20_000).select(
        F.col("id").cast("string"), F.concat(F.lit("u"), F.md5(F.col("id").cast("string"))).alias("url"), F.lit("t").alias("title"),
        F.repeat(F.lit("x"), 50).alias("text"), F.array(F.lit(1.0), F.rand(1)).cast("array<float>").alias("embedding"),
        (F.col("id") % 40).cast("int").alias("cid"),
    )
    S.create_collection(rows, target, 2)
    stored = S.load_collection(spark, target)
    url = stored.where("id = '77'").first()["url"]
    one = stored.where(F.col("url") == url)
    assert [r["id"] for r in one.select("id").collect()] == ["77"]

    def rows_read(df):
        df.collect()
        nodes, found = [df._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                nodes.append(node.executedPlan())
                continue
            if node.nodeName().startswith("Scan"):
                found += node.metrics().apply("numOutputRows").value()
            kids = node.children()
            nodes += [kids.apply(i) for i in range(kids.size())]
        return found

    whole = rows_read(stored.where("length(url) > 0").select("id"))
    assert whole == 20_000 and rows_read(one.select("id")) < whole / 4


def test_insert_batches_bound_file_sizes(spark, tmp_path):
    target = S.create_collection(rows(spark, *map(str, range(25))).coalesce(1), str(tmp_path / "c"), 2, 10)
    assert len(list((tmp_path / "c").glob("*.parquet"))) == 3
    assert S.read_table(spark, target).count() == 25


def test_spread_leaves_large_inputs_alone(spark):
    few, many = spark.range(100).coalesce(1), spark.range(100).repartition(20)
    assert S.spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert S.spread(many).rdd.getNumPartitions() == 20


def test_empty_input_names_the_step(spark, tmp_path):
    S.write_table(rows(spark, "a").where("false"), str(tmp_path / "e"))
    with pytest.raises(ValueError, match="is empty. Run chunk first"):
        S.require(spark, str(tmp_path / "e"), "chunk")


def test_chain(spark, tmp_path):
    pages = spark.read.parquet(f"{TABLES}/pages.parquet")
    chain = Chain(spark, str(tmp_path / "chain"))
    with pytest.raises(ValueError, match="Run clean_pages first"):
        chain.chunk()
    queries = spark.read.parquet(f"{TABLES}/benchmark.parquet").select(
        F.col("item_id").alias("qid"), F.col("text").alias("qtext")
    )

    def factory():
        return lambda chats: [chat[1]["content"][-40:] for chat in chats]

    answers, shares = chain.run(pages, factory, queries)
    assert answers.count() == queries.count()
    assert answers.where("sources = ''").count() == 0
    assert [r["label"] for r in shares.collect()][-1] == "answers"
    assert 0 < shares.agg(F.sum("percent")).first()[0] <= 100.0001
    # The same pages again add nothing.
    before = S.read_table(spark, chain._at("pages")).count()
    chain.clean_pages(pages)
    assert S.read_table(spark, chain._at("pages")).count() == before
    # Stored and in-flight results agree.
    stored = S.load_collection(spark, chain._at("collection"))
    buckets = TwoLevel.read(spark, chain._at("centroids")).buckets
    every = search_text(queries, stored, buckets, nprobe=buckets.count())
    exact = search_text(queries, stored)
    assert every.exceptAll(exact).isEmpty() and exact.exceptAll(every).isEmpty()
    assert build_chunks(pages).count() == stored.count()


def test_changes(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", None)], "slug string, digest string")
    before = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "9"), ("c", None), ("e", "5")], "slug string, digest string")
    got = {r["slug"]: r["change"] for r in changes(now, before, "slug").collect()}
    assert got == {"a": "same", "b": "changed", "c": "same", "d": "new", "e": "gone"}


def test_vectors_are_carried_over_by_text(spark):
    stored = spark.createDataFrame(
        [("x", "t1", [1.0]), ("y", "t1", [1.0]), ("z", "t2", None), ("w", "t3", [3.0])], "id string, text string, embedding array<float>"
    ).withColumn("digest", text_digest("text"))
    rows = spark.createDataFrame([("x", "t1"), ("new", "t3"), ("z", "t2"), ("n", None)], "id string, text string")
    got = {r["id"]: r["embedding"] for r in carry_vectors(rows.withColumn("digest", text_digest("text")), stored).collect()}
    assert got == {"x": [1.0], "new": [3.0], "z": None, "n": None}


@pytest.fixture
def counting(spark):
    """An encoder of two numbers, and what it was asked to encode."""
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def encode(texts):
            calls.add(len(texts))
            return [[1.0 + len(t), 1.0 + t.count("e")] for t in texts]

        return encode

    def since():
        n, calls.value = calls.value, 0
        return n

    return factory, since


def whole(chain):
    rows = S.load_collection(chain.spark, chain._at("collection")).select("id", "url", "title", "text", "embedding")
    return {(r["id"], r["url"], r["title"], r["text"], *(round(x, 5) for x in r["embedding"])) for r in rows.collect()}


def test_a_second_run_encodes_what_is_new(spark, tmp_path, counting):
    factory, encoded = counting
    pages = spark.read.parquet(f"{TABLES}/pages.parquet")

    def chain(name):
        return Chain(spark, str(tmp_path / name), factory, "lengths", 2, nlist=9)

    first = chain("one")
    first.clean_pages(pages)
    assert first.sync() == {"new": first._has("pages") and S.read_table(spark, first._at("pages")).count()}
    n = S.load_collection(spark, first._at("collection")).count()
    assert encoded() == n
    # The same pages again, and whole stages again: nothing is encoded.
    first.clean_pages(pages)
    assert first.sync() == {} and encoded() == 0
    first.update_pages(pages)
    assert first.sync() == {} and encoded() == 0
    first.chunk()
    first.embed()
    assert encoded() == 0
    # One page changed at its end, one moved to another url, one new, two gone.
    kind = F.col("page_id")
    html = F.when(kind == 4, F.regexp_replace("html", "(?i)</article>", "<p>One more line.</p></article>")).otherwise(F.col("html"))
    url = F.when(kind == 6, F.concat("url", F.lit("moved/"))).otherwise(F.col("url"))
    later = pages.where(~kind.isin(8, 9)).withColumns({"html": html, "url": url})
    later = later.union(pages.where(kind == 5).select(F.lit(10**6), F.concat("url", F.lit("copy/")), "html"))
    slugs = folders(tmp_path / "one" / "pages")
    first.update_pages(later)
    assert first.sync() == {"changed": 1, "new": 2, "gone": 3}
    assert 1 <= encoded() <= 3  # the changed page's last chunks; moved and copied texts are known
    other = chain("two")
    other.clean_pages(later)
    other.sync()
    assert whole(first) == whole(other) and slugs.items() <= folders(tmp_path / "one" / "pages").items()
    for name in ("chunks", "vectors"):
        mine, fresh = (S.read_table(spark, c._at(name)).select("id", "slug", "text", "page_digest") for c in (first, other))
        assert mine.exceptAll(fresh).isEmpty() and fresh.exceptAll(mine).isEmpty()
    # Another encoder's vectors are not carried over.
    renamed = Chain(spark, str(tmp_path / "one"), factory, "other", 2, nlist=9)
    encoded()
    renamed.embed()
    assert encoded() == S.read_table(spark, renamed._at("vectors")).count()


def test_a_sync_that_fails_is_done_again(spark, tmp_path, counting, monkeypatch):
    factory, encoded = counting
    pages = spark.read.parquet(f"{TABLES}/pages.parquet").where("page_id < 30")
    chain = Chain(spark, str(tmp_path / "c"), factory, "lengths", 2, nlist=4)
    chain.clean_pages(pages.where("page_id < 25"))
    chain.sync()
    chain.clean_pages(pages)
    with monkeypatch.context() as patch:
        patch.setattr(Chain, "_replace", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            chain.sync()
    assert chain.sync()["new"] >= 1 and chain.sync() == {}
    again = Chain(spark, str(tmp_path / "d"), factory, "lengths", 2, nlist=4)
    again.clean_pages(pages)
    again.sync()
    assert whole(chain) == whole(again)


def test_default_question(spark):
    assert questions(spark).count() == 1
    assert questions(spark, ["a", "b"]).orderBy("qid").collect()[1]["qtext"] == "b"


def test_stream_takes_each_slug_once(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    pages = spark.read.parquet(f"{TABLES}/pages.parquet")

    def factory():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    def run():
        query = ingest_stream(
            spark, source, target, marks, files_per_batch=1, encoder_factory=factory, dim=2, encoder_id="lengths"
        )
        query.awaitTermination()
        return S.read_table(spark, target)

    pages.where("page_id < 20").write.parquet(source)
    first = run()
    assert first.select("slug").distinct().count() == 20
    # All pages again, later ones under slugs that were met: state from the checkpoint tells them.
    again = pages.withColumn("page_id", F.col("page_id") + 1000).withColumn("html", F.lit("<p>late</p>"))
    pages.union(again.where("page_id < 1020")).repartition(3).write.mode("append").parquet(source)
    second = run()
    want = build_chunks(pages)
    assert second.select("id", "text").exceptAll(want.select("id", "text")).isEmpty()
    assert second.count() == want.count() and second.where("size(embedding) = 2").count() == want.count()
    assert run().count() == want.count()


class FakeState:
    def __init__(self, value=None):
        self.value = value

    @property
    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value


def test_state_keeps_the_first_page_of_a_slug():
    import pandas as pd

    def page(*ids):
        return pd.DataFrame({"page_id": pd.array(ids, "Int64"), "url": "u", "html": "h", "slug": "s"})

    state = FakeState()
    (got,) = first_of_slug(("s",), iter([page(5, 3), page(4), page()]), state)
    assert got["page_id"].tolist() == [3] and list(got.columns) == ["page_id", "url", "html"] and state.value == (3,)
    assert list(first_of_slug(("s",), iter([page(1)]), state)) == []
    (got,) = first_of_slug(("t",), iter([page(None), page(None, 9)]), FakeState())
    assert got["page_id"].tolist() == [9]


def test_counts_while_writing(spark, tmp_path):
    target = str(tmp_path / "t")
    rows_ = spark.range(1000).withColumn("text", F.repeat(F.lit("x"), F.col("id").cast("int")))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "one write")
    seen = S.write_counted(rows_, target, rows=F.count(F.lit(1)), chars=F.sum(F.length("text")), long=F.count_if(F.length("text") > 900))
    jobs = tracker.getJobIdsForGroup("counted")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen == {"rows": 1000, "chars": 499_500, "long": 99} and len(jobs) == 1
    assert S.read_table(spark, target).count() == 1000


def test_one_file_a_page(spark, tmp_path):
    pages = spark.createDataFrame([("a__b", "u", "é", "x\ny"), ("c d+%", "v", None, "")], "slug string, url string, title string, text string")
    folder = S.write_page_files(pages, str(tmp_path / "p"))
    assert len(list((tmp_path / "p").glob("*.json"))) == 2
    assert {tuple(r) for r in S.read_clean_pages(spark, folder).collect()} == {tuple(r) for r in pages.collect()}
    S.write_page_files(pages.limit(1), folder)
    assert S.read_clean_pages(spark, folder).count() == 2


def test_runs_from_another_folder(tmp_path):
    """Executors need no installed package and no particular working folder."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('rows', e.entry(spark).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 50" in done.stdout, done.stderr[-2000:]
