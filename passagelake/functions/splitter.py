"""Recursive character splitting as one native expression.

A piece longer than ``size`` is only ever split again by finer separators, in
place, so the recursion is a flat pass per separator over an array of pieces.
Packing whole parts greedily up to ``size`` equals taking the longest prefix that
ends in the separator, which is one regular expression; nothing is shuffled and
no Python runs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from passagelake.config import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS
from passagelake.functions.fold import kept_strings


def _pack_by_regex(piece: Column, sep: str, size: int) -> Column:
    end = re.escape(sep)
    pattern = (
        rf"(?s).{{1,{size}}}+\z"  # all that is left fits
        rf"|.{{0,{size - len(sep)}}}{end}"  # as many whole parts as fit
        rf"|.*?{end}"  # one part that is too long
        r"|.+\z"  # a last part that is too long
    )
    return F.regexp_extract_all(piece, F.lit(pattern), F.lit(0))


def _pack_by_fold(piece: Column, sep: str, size: int) -> Column:
    """Same result for a separator that can overlap itself, as in a run of newlines."""
    parts = F.regexp_extract_all(piece, F.lit(rf"(?s).*?{re.escape(sep)}|.+\z"), F.lit(0))

    def step(held: Column, part: Column) -> Column:
        fits = F.length(held) + F.length(part) <= size
        return F.struct(
            F.when(fits, F.concat(held, part)).otherwise(part).alias("state"),
            F.when(~fits & (held != ""), held).alias("keep"),
        )

    return F.flatten(kept_strings(parts, F.lit(""), step, lambda held: F.when(held != "", held)))


def _level(pieces: Column, sep: str, size: int) -> Column:
    if sep == "":
        cut = lambda p: F.regexp_extract_all(p, F.lit(rf"(?s).{{1,{size}}}"), F.lit(0))
    elif sep == sep[0] * len(sep) and len(sep) > 1:
        cut = lambda p: F.when(
            F.contains(p, F.lit(sep + sep[0])), _pack_by_fold(p, sep, size)
        ).otherwise(_pack_by_regex(p, sep, size))
    else:
        cut = lambda p: _pack_by_regex(p, sep, size)
    if sep:
        divided = cut
        cut = lambda p: F.when(F.contains(p, F.lit(sep)), divided(p)).otherwise(F.array(p))
    return F.flatten(
        F.transform(pieces, lambda p: F.when(F.length(p) <= size, F.array(p)).otherwise(cut(p)))
    )


def split_recursive(
    text: Column, size: int = CHUNK_SIZE, separators: list[str] = SEPARATORS
) -> Column:
    """Array of pieces of at most ``size`` characters that concatenate to ``text``."""
    if size <= max(map(len, separators)):
        raise ValueError("size must be larger than the longest separator")
    pieces = F.array(text)
    for sep in separators:
        pieces = _level(pieces, sep, size)
    return F.when(text.isNotNull(), pieces)


def add_overlap(pieces: Column, overlap: int = CHUNK_OVERLAP) -> Column:
    """Each piece after the first, led by the last ``overlap`` characters before it.

    ``pieces`` has to be a plain column: it is read once per element.
    """
    if overlap <= 0:
        return pieces
    return F.transform(
        pieces,
        lambda p, i: F.when(i == 0, p).otherwise(
            F.concat(F.right(F.get(pieces, i - 1), F.lit(overlap)), p)
        ),
    )
