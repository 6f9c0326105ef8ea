import random

import pytest
from pyspark.sql import functions as F

from passagelake.config import SEPARATORS
from passagelake.functions.splitter import add_overlap, split_recursive
from passagelake.operators.chunks import chunk_pages, chunk_stats, presented


def model(text, size, level=0):
    """Plain recursive splitting, to compare with."""
    if len(text) <= size:
        return [text]
    sep = SEPARATORS[level]
    if not sep:
        return [text[i : i + size] for i in range(0, len(text), size)]
    pieces, held = [], ""
    *heads, last = text.split(sep)
    for part in [h + sep for h in heads] + [last]:
        if len(held) + len(part) > size:
            pieces += [held] if held else []
            held = part
            if len(part) > size:
                pieces += model(part, size, level + 1)
                held = ""
        else:
            held += part
    return pieces + ([held] if held else [])


def split(spark, texts, size):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select("i", split_recursive(F.col("text"), size).alias("p")).orderBy("i").collect()
    return [r["p"] for r in rows]


EDGE = [
    "", "x" * 800, "x" * 801, "a\n\n\nb" * 300, "\n" * 2500, "\n\n" * 900, "a\n\n\n\n\n" * 200,
    "sentence. " * 200, "x" * 799 + ". " + "y" * 900, "word " * 500 + "z" * 1700 + " tail",
    "😀" * 1700, "😀 é\n" * 700, "a" * 900 + "\n\n", "\n\n" + "b" * 900, "tail" + "\n\n" + "q" * 801 + "\n\n" + "r",
    "one; two, three! four? " * 90, "a" * 500 + "\r\n" + "b" * 500, "x.\n" * 600, " " * 2000,
    "p" * 790 + "\n\n" + "q" * 8 + "\n\n" + "r" * 50, "\x85" * 900 + " " + "y" * 900,
]


@pytest.mark.parametrize("size", [800, 60, 7])
def test_pieces_equal_the_recursive_model(spark, size):
    rng = random.Random(size)
    alphabet = ["a", "bc", "é", "😀", " ", "\n", "\n\n", "\n\n\n", ". ", "? ", "! ", "; ", ", ", ".", "word"]
    weights = [6, 4, 2, 1, 8, 2, 1, 1, 2, 1, 1, 1, 2, 1, 6]
    drawn = ["".join(rng.choices(alphabet, weights, k=rng.randint(0, 1500))) for _ in range(150)]
    texts = EDGE + drawn
    for text, pieces in zip(texts, split(spark, texts, size)):
        assert pieces == model(text, size)
        assert "".join(pieces) == text
        assert all(len(p) <= size for p in pieces)


def test_overlap_uses_the_plain_predecessor(spark):
    df = spark.createDataFrame([(["abcdef", "gh", "ijklm"],), (["one"],)], "ps array<string>")
    got = [r[0] for r in df.select(add_overlap(F.col("ps"), 4)).collect()]
    assert got == [["abcdef", "cdefgh", "ghijklm"], ["one"]]
    assert df.select(add_overlap(F.col("ps"), 0)).first()[0] == ["abcdef", "gh", "ijklm"]


def test_chunks_of_pages(spark):
    body = "\n".join(f"line {i} " + "x" * 60 for i in range(60))
    pages = spark.createDataFrame(
        [("a", "u", "t", body), ("b", "u2", "t2", ""), ("c", "u3", "t3", " short ")],
        "slug string, url string, title string, text string",
    )
    chunks = chunk_pages(pages)
    rows = chunks.orderBy("id").collect()
    mine = [r for r in rows if r["slug"] == "a"]
    pieces = model(body, 800)
    tails = [""] + [p[-120:] for p in pieces]
    assert [r["text"] for r in mine] == [(t + p).strip() for t, p in zip(tails, pieces)]
    assert [r["id"] for r in mine] == [f"a__{i:04d}" for i in range(len(pieces))]
    assert all(len(r["text"]) <= 920 for r in rows)
    assert [r["text"] for r in rows if r["slug"] != "a"] == ["", "short"]
    stats = chunk_stats(chunks).first()
    assert (stats["chunks"], stats["pages"]) == (len(rows), 3)
    assert stats["mean_chars"] == pytest.approx(sum(len(r["text"]) for r in rows) / len(rows))


def test_chunking_shuffles_nothing(spark):
    pages = spark.createDataFrame(
        [("a", "u", "t", "x")], "slug string, url string, title string, text string"
    )
    plan = chunk_pages(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "slug string, text string")
    assert tuple(chunk_stats(empty).first()) == (0, 0, 0.0)


def test_presented_in_file_order(spark):
    rows = [("b", 1), ("a", 10), ("b", 0), ("a", 2)]
    shown = presented(spark.createDataFrame(rows, "slug string, chunk_idx int").repartition(3))
    assert [tuple(r) for r in shown.collect()] == sorted(rows)
