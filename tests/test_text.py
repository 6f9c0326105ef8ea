import textwrap

import pytest
from pyspark.sql import functions as F

from passagelake.functions import text as T


def apply(spark, fn, *values):
    """``fn`` of each value, in order."""
    rows = [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
    width = len(rows[0]) - 1
    df = spark.createDataFrame(rows, ["i"] + [f"c{n}" for n in range(width)])
    out = df.select("i", fn(*[F.col(f"c{n}") for n in range(width)]).alias("x"))
    return [r["x"] for r in out.orderBy("i").collect()]


def test_slug(spark):
    site = "https://docs.example.org/"
    urls = [site, site + "a/b-c/", site + "a/b/c", site + "--x--", "https://other.org/p", site + "é/ü"]
    assert apply(spark, lambda u: T.slugify(u, site), *urls) == [
        "index", "a__b__c", "a__b__c", "__x__", "https__other__org__p", "__",
    ]


def test_strip_is_unicode_aware(spark):
    texts = ["　 a b\x85", "\t\n\x1c", "x", "​y"]
    assert apply(spark, T.strip, *texts) == [t.strip() for t in texts]


def test_chunk_id_widens(spark):
    ids = apply(spark, T.chunk_id, ("p", 0), ("p", 9999), ("p", 10000))
    assert ids == ["p__0000", "p__9999", "p__10000"]


def test_preview_like_textwrap(spark):
    long = "word " * 100
    texts = [
        "short\ntext", "", "  a \n\n b\tc  ", long, "x" * 280, "x" * 281, "x" * 278 + " y",
        "x" * 277 + " yyyyyy", "a" * 270 + " multi-node job " + "b" * 30,
        "a" * 268 + " multi-node job " + "b" * 30, "a" * 270 + " 12-34-56 " + "b" * 30,
        "a" * 272 + " b--c " + "d" * 20, "é" * 100 + " " + "ö" * 175 + " " + "ü" * 40,
        "q " * 139 + "qq rest", "ends here " * 28 + "x", "a" * 274 + "--bcd " + "e" * 20,
        *("ab " * 40 + "word" + "-" * n + "next " + "c" * 160 for n in (59, 60, 61, 62, 100)),
        "x" + "-" * 274 + "y " + "z" * 30, "x" + "-" * 275 + "y " + "z" * 30,
    ]
    want = [
        textwrap.shorten(t.replace("\n", " "), width=280, placeholder=" ...") for t in texts
    ]
    assert apply(spark, T.preview, *texts) == want


def test_scores(spark):
    assert apply(spark, T.score_text, 0.12344, -0.5, 1.0, 0.0) == [
        "+0.1234", "-0.5000", "+1.0000", "+0.0000"
    ]
    bands = apply(spark, T.score_band, 0.55, 0.5499, 0.45, 0.4499, 0.35, 0.3499, -1.0)
    assert bands == ["good", "fair", "fair", "weak", "weak", "poor", "poor"]
    assert apply(spark, T.rank_text, 3) == ["#3"]


@pytest.mark.parametrize("text", ["  passage \n", "x"])
def test_context_block(spark, text):
    assert apply(spark, T.context_block, (2, text)) == [f"[2] {text.strip()}"]


def test_user_message(spark):
    got = apply(spark, T.user_message, ("[1] a\n\n[2] b", "why?"))
    assert got == ["Context:\n[1] a\n\n[2] b\n\nQuestion: why?\nAnswer:"]
