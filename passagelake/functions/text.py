"""Scalar text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from passagelake.config import (
    INDEX_SLUG,
    LOWEST_BAND,
    PREVIEW_PLACEHOLDER,
    PREVIEW_WIDTH,
    SCORE_BANDS,
)

# What counts as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(col: Column) -> Column:
    """Remove white space, Unicode's included, from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def slugify(url: Column, site_prefix: str = "") -> Column:
    """File-safe stem of a URL: ``site/a/b-c/`` becomes ``a__b__c``."""
    path = F.replace(url, F.lit(site_prefix), F.lit("")) if site_prefix else url
    slug = F.regexp_replace(F.btrim(path, F.lit("/")), "[^a-zA-Z0-9]+", "__")
    return F.when(slug == "", F.lit(INDEX_SLUG)).otherwise(slug)


def chunk_id(slug: Column, idx: Column) -> Column:
    """``<slug>__<idx>`` with at least four digits."""
    return F.format_string("%s__%04d", slug, idx)


def preview(text: Column, width: int = PREVIEW_WIDTH) -> Column:
    """One line of at most ``width`` characters, cut between words or after a hyphen."""
    room = width - len(PREVIEW_PLACEHOLDER)
    letter = r"[\p{L}\p{M}_]"
    cut = (
        rf"(?s)^(.{{1,{room}}})(?:(?= )"
        rf"|(?<={letter}{letter}-|{letter}-{letter}-)(?={letter}-?{letter})"
        r"|(?<=[\p{L}\p{N}_!\"'&.,?])(?=-{2,}[\p{L}\p{N}_])"
        rf"|(?<=[\p{{L}}\p{{N}}_!\"'&.,?]-{{2,{room}}})(?=[\p{{L}}\p{{N}}_]))"
    )

    def shortened(line: Column) -> Column:
        head = F.regexp_extract(line, cut, 1)
        return F.when(F.length(line) <= width, line).otherwise(
            F.when(head == "", F.lit(PREVIEW_PLACEHOLDER.strip())).otherwise(
                F.concat(head, F.lit(PREVIEW_PLACEHOLDER))
            )
        )

    spaced = F.translate(text, WHITESPACE, " " * len(WHITESPACE))
    line = F.btrim(F.regexp_replace(spaced, " {2,}", " "))
    # The lambda reads the line several times but has it computed once.
    return F.get(F.transform(F.array(line), shortened), F.lit(0))


def score_text(score: Column) -> Column:
    """Signed score with four decimals, such as ``+0.1234``."""
    return F.format_string("%+.4f", score)


def rank_text(rank: Column) -> Column:
    return F.format_string("#%d", rank)


def score_band(score: Column) -> Column:
    """Name of the band a similarity falls into."""
    band = F.lit(LOWEST_BAND)
    for floor, name in reversed(SCORE_BANDS):
        band = F.when(score >= floor, F.lit(name)).otherwise(band)
    return band


def context_block(rank: Column, text: Column) -> Column:
    """Numbered passage: ``[2] passage text``."""
    return F.concat(F.lit("["), rank.cast("string"), F.lit("] "), strip(text))


def user_message(context: Column, question: Column) -> Column:
    return F.concat(
        F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), question, F.lit("\nAnswer:")
    )


def messages(system_text: str, user_text: Column) -> Column:
    """The two chat messages, system then user."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(system_text)), message("user", user_text))
