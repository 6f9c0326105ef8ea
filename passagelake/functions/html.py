"""Title and body text of a web page as native expressions.

Every comment, dropped element and tag becomes a mark between text nodes; the
text is split at the marks, each node is stripped, and the rest is joined.
Elements that can hold themselves (``article``, ``nav`` ...) are matched by depth; furniture
that is never closed ends where the element around it ends.

The functions work in steps on a DataFrame, so that each intermediate text is one
column that is computed once.
"""

from __future__ import annotations

from functools import reduce
from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

from passagelake.config import UNTITLED
from passagelake.functions.fold import kept_strings, let
from passagelake.functions.text import strip

# Noncharacters: they cannot stand in a page, so they can mark places in it.
_NODE = "\ufdd0"
_OPEN = "\ufdd1"
_CLOSE = "\ufdd2"

# The rest of a tag after its name; quoted attribute values may hold ">".
_TAIL = r"(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)"
_NAME_END = r"(?=[\s/>])"

# Elements whose text is never page text.
_SILENT = "script|style|template|rp|rt"
# Page furniture dropped from the body.
_CHROME = ["nav", "header", "footer"]
_CHROME_CLASS = "headerlink"

# Elements that have no content and no end tag.
_VOID = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
]
# Characters of a path of open elements beyond which no more are told apart.
_DEEPEST = 4096

# References that may stand without a semicolon, longer names first.
_LENIENT = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_ENTITY = (
    r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]{1,31};|(?:" + "|".join(_LENIENT) + "))"
)


def _open_tag(names: str) -> str:
    return rf"(?is)<(?:{names}){_NAME_END}{_TAIL}"


def _close_tag(names: str) -> str:
    return rf"(?is)</(?:{names})\s*>"


def _without_empty(html: Column, names: str) -> Column:
    """Drop tags that close themselves, such as ``<nav/>``."""
    return F.regexp_replace(html, rf"{_open_tag(names)}(?<=/>)", _NODE)


def _mark_elements(html: Column, names: str) -> Column:
    marked = F.regexp_replace(html, _open_tag(names), _OPEN)
    return F.regexp_replace(marked, _close_tag(names), _CLOSE)


def _segments(marked: Column) -> Column:
    return F.regexp_extract_all(
        marked, F.lit(f"(?s)[{_OPEN}{_CLOSE}][^{_OPEN}{_CLOSE}]*+"), F.lit(0)
    )


def _joined(kept: Column) -> Column:
    return F.array_join(F.flatten(kept), _NODE)


def _rest(seg: Column) -> Column:
    return F.substring(seg, 2, 2**31 - 1)


def _next(state: Column, keep: Column) -> Column:
    return F.struct(state.alias("state"), keep.alias("keep"))


def _inside_first(html: Column, name: str) -> Column:
    """Content of the first ``name`` element, elements of that name inside it included."""

    def step(depth: Column, seg: Column) -> Column:  # a negative depth: the element has ended
        opens = F.startswith(seg, F.lit(_OPEN))
        closed = ~opens & (depth == 1)
        ignored = (depth < 0) | (~opens & (depth == 0))
        after = F.when(ignored, depth).when(closed, F.lit(-1)).when(opens, depth + 1).otherwise(depth - 1)
        return _next(after, F.when(~(ignored | closed), _rest(seg)))

    return _joined(kept_strings(_segments(_mark_elements(html, name)), F.lit(0), step))


def _outside_all(html: Column, names: str) -> Column:
    """What is left when elements called ``names`` are dropped with their content, by depth."""

    def step(depth: Column, seg: Column) -> Column:
        after = F.when(F.startswith(seg, F.lit(_OPEN)), depth + 1).otherwise(F.greatest(depth - 1, F.lit(0)))
        return _next(after, F.when(after == 0, _rest(seg)))

    marked = F.concat(F.lit(_CLOSE), _mark_elements(_without_empty(html, names), names))
    return _joined(kept_strings(_segments(marked), F.lit(0), step))


def _outside_unclosed(html: Column, names: list[str]) -> Column:
    """The same for pages whose tags don't balance: an element ends where one around it ends.

    Names of open elements are kept as a path; an end tag closes the innermost element of
    its name with all inside it, and is ignored if none is open.  A path of more than
    ``_DEEPEST`` characters takes no further names, so the cost of a tag is bounded.
    """
    within = lambda path: reduce(lambda a, b: a | b, [F.contains(path, F.lit(f"|{n}|")) for n in names])

    def after(path: Column, tag: Column) -> Column:
        name = F.regexp_replace(tag, "^/", "")
        key = F.concat(F.lit("|"), name, F.lit("|"))
        cut = F.left(path, F.length(path) - F.length(F.call_function("substring_index", path, key, F.lit(-1))) - F.length(key) + 1)
        full = (F.length(path) > _DEEPEST) & ~(name.isin(*names) & ~within(path))
        return (
            F.when(name.isin("", *_VOID), path)
            .when(F.startswith(tag, F.lit("/")), F.when(F.contains(path, key), cut).otherwise(path))
            .otherwise(F.when(full, path).otherwise(F.concat(path, name, F.lit("|"))))
        )

    def step(path: Column, seg: Column) -> Column:
        tag = F.lower(F.substring_index(seg, _NODE, 1))
        text = F.substring_index(seg, _NODE, -1)
        return let(after(path, tag), lambda p: _next(p, F.when(~within(p), text)))

    bare = F.regexp_replace(html, rf"(?is)<[a-z][a-z0-9:-]*+{_NAME_END}{_TAIL}(?<=/>)", _NODE * 2)
    marked = F.regexp_replace(bare, rf"(?is)<(/?)([a-z][a-z0-9:-]*+){_NAME_END}{_TAIL}", f"{_OPEN}$1$2{_NODE}")
    # Marks inside a text between two tags separate nodes, too.
    parts = F.split(F.concat(F.lit(_NODE), marked), _OPEN)
    single = F.transform(parts, lambda p: F.regexp_replace(p, rf"(?<!^){_NODE}{_NODE}", _CLOSE))
    return F.translate(_joined(kept_strings(single, F.lit("|"), step)), _CLOSE, _NODE)


def _without_furniture(html: Column) -> Column:
    names = "|".join(_CHROME)
    bare = _without_empty(html, names)
    balanced = F.regexp_count(bare, F.lit(_open_tag(names))) == F.regexp_count(bare, F.lit(_close_tag(names)))
    return F.when(balanced, _outside_all(html, names)).otherwise(_outside_unclosed(html, _CHROME))


def unescape(text: Column) -> Column:
    """Resolve named and numeric character references in one pass.

    Numeric references and the names of old may lack their semicolon; a name that is
    unknown up to its semicolon counts by its longest beginning that may lack it.
    """
    named = {**name2codepoint, "apos": 39}
    known = {f"&{name};": chr(code) for name, code in named.items()} | {
        f"&{n}{end}": html5[n] for n in _LENIENT for end in ("", ";")
    }
    pairs = "\n".join(f"{name}\t{char}" for name, char in known.items())
    names = F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("\t"))

    def resolve(token: Column) -> Column:
        is_hex = F.substring(token, 3, 1).isin("x", "X")
        digits = F.regexp_extract(token, r"^&#[xX]?0*+([0-9a-fA-F]*);?$", 1)
        # More digits than the last code point has are beyond it.
        digits = F.when(F.length(digits).between(1, 7), digits).otherwise(F.lit("0"))
        code = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        usable = (
            (code > 0) & (code <= 0x10FFFF)
            & ~code.between(0xD800, 0xDFFF) & ~code.between(0xFDD0, 0xFDEF)
        )
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        numeric = F.when(usable, char).otherwise(F.lit("\ufffd"))
        return (
            F.when(F.length(token) < 3, token)
            .when(~F.startswith(token, F.lit("&")), token)
            .when(F.startswith(token, F.lit("&#")), numeric)
            .otherwise(F.coalesce(names[token], let(
                F.regexp_extract(token, rf"^&(?:{'|'.join(_LENIENT)})", 0),
                lambda n: F.concat(names[n], F.substring(token, F.length(n) + 1, F.lit(2**31 - 1))),
            ), token))
        )

    tokens = F.regexp_extract_all(text, F.lit(rf"(?s){_ENTITY}|[^&]++|&"), F.lit(0))
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, resolve), "")
    ).otherwise(text)


def _text_nodes(markup: Column, glue: str) -> Column:
    plain = unescape(F.regexp_replace(markup, rf"(?is)<[a-z/!?]{_TAIL}", _NODE))
    nodes = F.transform(F.split(plain, _NODE), strip)
    return F.array_join(F.filter(nodes, lambda n: n != ""), glue)


def _has(html: Column, name: str) -> Column:
    return html.rlike(rf"(?i)<{name}{_NAME_END}")


def _first_content(html: Column, name: str) -> Column:
    return F.regexp_extract(html, rf"{_open_tag(name)}(.*?)(?:</{name}\s*>|\z)", 1)


def _without_silent(html: Column) -> Column:
    silent = (
        rf"(?is)<!--.*?(?:-->|\z)|<({_SILENT}){_NAME_END}{_TAIL}.*?(?:</\1\s*>|\z)"
    )
    bare = F.translate(html, _NODE + _OPEN + _CLOSE, "")
    return F.regexp_replace(bare, silent, _NODE)


def _without_headerlinks(html: Column) -> Column:
    """Drop elements of the anchor-sign class; few pages have any."""
    word = rf"(?<![\w-]){_CHROME_CLASS}(?![\w-])"
    value = rf"(?:\"[^\">]*{word}[^\">]*\"|'[^'>]*{word}[^'>]*'|{_CHROME_CLASS}(?=[\s>]))"
    element = rf"(?is)<([a-z][a-z0-9]*)\s(?=[^>]*\bclass\s*=\s*{value}){_TAIL}.*?</\1\s*>"
    return F.when(
        F.contains(html, F.lit(_CHROME_CLASS)), F.regexp_replace(html, element, _NODE)
    ).otherwise(html)


def _body(html: Column) -> Column:
    headless = F.regexp_replace(
        html, rf"{_open_tag('head')}.*?</head\s*>|{_open_tag('title')}.*?</title\s*>", _NODE
    )
    return (
        F.when(_has(html, "article"), _inside_first(html, "article"))
        .when(_has(html, "body"), _first_content(html, "body"))
        .otherwise(headless)
    )


def page_title(html: Column) -> Column:
    """Text of the first ``h1`` of the document, else of ``title``, else a fixed word."""
    titled = F.when(_has(html, "h1"), _first_content(html, "h1")).when(
        _has(html, "title"), _first_content(html, "title")
    )
    return F.coalesce(_text_nodes(titled, ""), F.lit(UNTITLED))


def with_title_and_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the ``html`` column by ``title`` and ``text``."""
    keep = [c for c in pages.columns if c != html]
    cleaned = pages.select(*keep, _without_silent(F.col(html)).alias("_html"))
    bodies = cleaned.select(*keep, "_html", _body(F.col("_html")).alias("_body"))
    bodies = bodies.select(*keep, "_html", _without_headerlinks(F.col("_body")).alias("_main"))
    main = _without_furniture(F.col("_main"))
    text = F.regexp_replace(_text_nodes(main, "\n"), r"\n{3,}", "\n\n")
    return bodies.select(*keep, page_title(F.col("_html")).alias("title"), text.alias("text"))
