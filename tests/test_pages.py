from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from passagelake.functions.html import unescape, with_title_and_text
from passagelake.operators.pages import (
    extract_pages,
    ingest_pages,
    new_pages,
    page_outcomes,
    processed_counts,
    split_bad_pages,
)


def extract(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    rows = with_title_and_text(df).orderBy("i").collect()
    return [(r["title"], r["text"]) for r in rows]


CASES = {
    "no heading": ("<title> A  b </title><p>x</p>", ("A  b", "x")),
    "nothing": ("<p>x</p>", ("Untitled", "x")),
    "heading outside the article": ("<h1>T</h1><article><p>x</p></article>", ("T", "x")),
    "empty heading wins": ("<title>A</title><body><h1></h1>x</body>", ("", "x")),
    "tags in heading": ("<h1> Big <b>bold</b> <i> word</i></h1>", ("Bigboldword", "Big\nbold\nword")),
    "no article": ("<html><head><title>T</title></head><body>a<p>b</body></html>", ("T", "a\nb")),
    "no body": ("<html><head><title>T</title></head><p>a", ("T", "a")),
    "chrome": (
        "<article><nav>n<ul><li>m</li></ul></nav><header>h</header>a<footer>f</footer>"
        "<script>if (a < b) '</p>'</script><style>p{}</style>b</article>", ("Untitled", "a\nb")),
    "chrome outside": ("<nav>n</nav><article>a</article><footer>f</footer>", ("Untitled", "a")),
    "custom element": ("<article><nav-bar>kept</nav-bar></article>", ("Untitled", "kept")),
    "nested articles": (
        "<article>a<article>b</article>c</article><article>d</article>", ("Untitled", "a\nb\nc")),
    "nested chrome": (
        "<article><header>x<header>y</header>z<nav>n</nav></header>kept</article>", ("Untitled", "kept")),
    "unclosed article": ("<article>a<p>b", ("Untitled", "a\nb")),
    "empty article": ("<body>x<article></article></body>", ("Untitled", "")),
    "anchor sign": (
        '<article><h1>T<a class="headerlink" href="#t">¶</a></h1><p>a <span class=\'x headerlink y\'>s</span></p>'
        '<a class="headerlinks">k</a></article>', ("T¶", "T\na\nk")),
    "comment": ("<article>a<!-- <p>no</p> -->b</article>", ("Untitled", "a\nb")),
    "commented tags": ("<article>a<!-- </article> -->b</article>c", ("Untitled", "a\nb")),
    "code stays": ("<article><pre>x = 1\n\n\n\ny</pre><code>z</code></article>", ("Untitled", "x = 1\n\ny\nz")),
    "entities": (
        "<h1>A &amp;lt; B</h1><p>&nbsp;x&nbsp;</p><p>&#233;&#xe9;&eacute; &unknown; &copy; 5 & 6 &#0;</p>",
        ("A &lt; B", "A &lt; B\nx\nééé &unknown; © 5 & 6 �")),
    "quoted bracket": ('<article><img alt="a > b">x<a title=\'>\'>y</a></article>', ("Untitled", "x\ny")),
    "less than": ("<article>1 < 2 and <b>3</b></article>", ("Untitled", "1 < 2 and\n3")),
    "ruby and template": ("<article>a<template><p>t</p></template><rp>(</rp>b</article>", ("Untitled", "a\nb")),
    "upper case": ("<ARTICLE><NAV>n</NAV><P>x</P></ARTICLE>", ("Untitled", "x")),
    "empty": ("", ("Untitled", "")),
    "many attributes": (
        "<article><img " + " ".join(f"a{n}='{n}'" for n in range(400)) + ' z="a > b">hello</article>',
        ("Untitled", "hello")),
    "long references": (
        "<p>&#00000038;&#x0000026;&#0000000000000000000065;&#99999999999999999999;&#x110000;", ("Untitled", "&&A\ufffd\ufffd")),
    "furniture that closes itself": (
        "<article><nav/><p>kept</p><header class='a>b'  /><footer>f</footer></article>", ("Untitled", "kept")),
}


def test_cases(spark):
    got = extract(spark, *[page for page, _ in CASES.values()])
    assert dict(zip(CASES, got)) == {name: want for name, (_, want) in CASES.items()}


def test_hostile_pages_do_not_overflow(spark):
    pages = [
        "<article>" * 3000 + "x" + "</article>" * 3000,
        "<article><nav " + "a='1' " * 5000 + ">n</nav>x</article>",
        "<article><a " + '"' * 20001 + ">x</article>",
        "<article>" + "<b>" * 20000 + "x</article>",
        "<article>" + "&amp;" * 20000 + "</article>",
        "<article><!--" + "x" * 200000 + "-->y</article>",
        "<p>" + "<" * 20000,
    ]
    got = extract(spark, *pages)
    assert got[0][1] == "x" and got[1][1] == "x" and got[3][1] == "x" and got[5][1] == "y"
    assert got[4][1] == "&" * 20000


class Reader(HTMLParser):
    """Title and text nodes by a real parser, for pages that close what they open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.path, self.nodes, self.heading, self.seen = [], [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("nav", "header", "footer", "script", "style", "article", "h1"):
            self.path.append(tag)
        self.nodes.append("\0")

    def handle_endtag(self, tag):
        if tag in self.path:
            while self.path.pop() != tag:
                pass
            self.seen += tag == "h1"
        self.nodes.append("\0")

    def handle_comment(self, data):
        self.nodes.append("\0")

    def handle_data(self, data):
        dropped = {"nav", "header", "footer", "script", "style"} & set(self.path)
        if "h1" in self.path and not self.seen:
            self.heading.append(data.strip())
        if "article" in self.path and not dropped:
            self.nodes.append(data)

    def result(self):
        nodes = [n.strip() for n in "".join(self.nodes).split("\0")]
        return "".join(self.heading), "\n".join(n for n in nodes if n)


def test_fixture_pages_like_a_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in extract_pages(pages).collect():
        reader = Reader()
        reader.feed(raw[row["page_id"]])
        assert (row["title"], row["text"]) == reader.result()


def test_unescape_knows_the_named_characters(spark):
    from html.entities import name2codepoint

    text = " ".join(f"&{n};" for n in name2codepoint)
    got = spark.createDataFrame([(text,)], "t string").select(unescape(F.col("t"))).first()[0]
    assert got == " ".join(chr(code) for code in name2codepoint.values())


SITE = "https://s.org/"


@pytest.fixture
def raw_pages(spark):
    rows = [
        (1, SITE + "a-b", "<h1>1</h1>"), (2, SITE + "a/b", "<h1>2</h1>"), (3, SITE + "c", "<h1>3</h1>"),
        (4, SITE + "d", None), (5, None, "<h1>5</h1>"), (6, SITE, "<h1>6</h1>"), (7, SITE + "old", "<h1>7</h1>"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.fixture
def stored(spark):
    return spark.createDataFrame(
        [("old", SITE + "old", "kept", "kept text")],
        "slug string, url string, title string, text string",
    )


def test_only_new_slugs_are_read(spark, raw_pages, stored):
    fresh = new_pages(raw_pages, stored, SITE)
    assert {r["slug"]: r["page_id"] for r in fresh.collect()} == {"a__b": 1, "c": 3, "index": 6}
    merged = ingest_pages(raw_pages, stored, SITE).collect()
    assert {(r["slug"], r["title"], r["origin"]) for r in merged} == {
        ("old", "kept", "cached"), ("a__b", "1", "new"), ("c", "3", "new"), ("index", "6", "new"),
    }


def test_outcomes(spark, raw_pages, stored):
    found = page_outcomes(raw_pages, stored, SITE)
    assert {r["page_id"]: r["outcome"] for r in found.collect()} == {
        1: "new", 2: "slug taken", 3: "new", 4: "html missing", 5: "url missing", 6: "new", 7: "cached",
    }
    assert {r["outcome"]: r["pages"] for r in processed_counts(found).collect()}["new"] == 3
    good, bad = split_bad_pages(raw_pages)
    assert good.count() == 5
    assert {r["page_id"]: r["reason"] for r in bad.collect()} == {4: "html missing", 5: "url missing"}


def test_a_shared_slug_is_thinned_before_the_shuffle(spark, raw_pages, stored):
    plan = new_pages(raw_pages, stored, SITE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


UNCLOSED = {
    "ends with the element around it": (
        "<article><div><nav>links</div><p>kept?</p></article>", "kept?"),
    "unclosed to the end": ("<article><p>a</p><nav>links<p>more</article>", "a"),
    "paragraphs inside": ("<article><section><p>a<p>b<header>x<p>y</section>c</article>", "a\nb\nc"),
    "inside furniture": ("<article><nav>x<div><footer>y</div>z</nav>kept<footer>w</article>", "kept"),
    "an end tag that nothing opened": ("<article><nav>x</span>y</b></nav>kept<nav>z</article>", "kept"),
    "void elements": ("<article><div><nav>x<br><img src=a><hr></div>kept<br>too</article>", "kept\ntoo"),
    "closes itself": ("<article><nav/>a<nav>x<nav/>y</nav>b<div><footer>z</div>c<br/>d</article>", "a\nb\nc\nd"),
    "closed too often": ("<article>a</nav>b<nav>x</nav></nav>c</article>", "a\nb\nc"),
    "upper case, other names": ("<ARTICLE><DIV><NAV>n</DIV><nav-bar>kept</nav-bar></ARTICLE>", "kept"),
    "quoted bracket": ("<article><div a='<nav>'><nav b='>'>x</div>y 1 < 2</article>", "y 1 < 2"),
}


def test_furniture_that_is_never_closed(spark):
    got = extract(spark, *[page for page, _ in UNCLOSED.values()])
    assert dict(zip(UNCLOSED, (text for _, text in got))) == {name: text for name, (_, text) in UNCLOSED.items()}


class Stack(HTMLParser):
    """Text outside furniture when an end tag closes all that is open inside its element."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.path, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag != "br":
            self.path.append(tag)

    def handle_endtag(self, tag):
        if tag in self.path:
            while self.path.pop() != tag:
                pass

    def handle_data(self, data):
        if not {"nav", "header", "footer"} & set(self.path):
            self.out.append(data.strip())


def test_broken_pages_like_a_parser(spark):
    import random

    chooser, pages = random.Random(4), []
    for _ in range(300):
        parts = []
        for n in range(chooser.randrange(25)):
            tag = chooser.choice(["div", "p", "nav", "header", "footer", "section", "br"])
            parts.append(chooser.choice([f"<{tag}>", f"</{tag}>", f" t{n} "]))
        pages.append("".join(parts) + "<nav>")  # never balanced by accident
    pages = [p for p in pages if sum(p.count(f"<{c}>") - p.count(f"</{c}>") for c in ("nav", "header", "footer"))]
    got = extract(spark, *pages)
    for page, (_, text) in zip(pages, got):
        reader = Stack()
        reader.feed(page)
        reader.close()
        assert text == "\n".join(t for t in reader.out if t), page


def test_broken_hostile_pages_stay_fast(spark):
    import time

    pages = [
        "<article>" + "<nav>" * 30_000 + "x",
        "<article>" + "<div><nav>x</div>y" * 20_000 + "</article>",
        "<article>" + "<div>" * 30_000 + "<nav>x" + "</div>" * 30_000 + "y",
        "<article>" + "<nav>n</nav>k" * 30_000 + "</article>",
        "<article><nav>" + "".join(f"<x{n}>" for n in range(20_000)) + "z",
    ]
    start = time.time()
    got = extract(spark, *pages)
    assert time.time() - start < 60
    assert got[0][1] == "" and got[1][1].count("y") == 20_000 and got[2][1] == "y" and got[3][1].count("k") == 30_000


def test_references_without_a_semicolon(spark):
    from html import unescape as reference

    texts = [
        "&copy 2024", "&copy; &copyfoo; &notit; &notin; &amp &lt&gt x", "&#65 &#x42g &#66;", "&unknown &unknown; &;",
        "a&b &ampamp; &AMP;&QUOT &nbsp&nbsp;x", "&eacutee &Eacute", "& &# &#x &1;",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescape(F.col("t")).alias("u")).collect()
    assert {r["t"]: r["u"] for r in rows} == {t: reference(t) for t in texts}
