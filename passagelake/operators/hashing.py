"""Token counts of many texts at once, without an object for each token.

Texts come in lower case.  Which of their characters are letters or digits is looked up in a table of the
blocks whose characters are all assigned; a text that holds others comes with blanks in the place of all that is
neither (``token_text``), so that everything else in it is.  Different tokens of a block are hashed
together, by MD5 over arrays.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

#: Texts, and bytes of them, whose tokens are counted at once; words that are hashed at once.
BLOCK_TEXTS, BLOCK_BYTES, BLOCK_WORDS = 4_096, 4 << 20, 8_192

#: The characters that the tables know: below U+0250, and the general punctuation, of which none is a letter.
_KNOWN = r"\x{0}-\x{24F}\x{2000}-\x{206F}"
_LETTERS = np.array([c >= 0x250 or unicodedata.category(chr(c))[0] in "LN" for c in range(0x280)])
_BYTES = np.concatenate([_LETTERS[:0x80], np.ones(0x80, bool)])

_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_PLACES = [*range(16), *((5 * i + 1) % 16 for i in range(16)), *((3 * i + 5) % 16 for i in range(16)), *(7 * i % 16 for i in range(16))]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def token_text(text: Column) -> Column:
    """The text in lower case, as ``bucket_counts`` reads it."""
    lowered = F.lower(text)
    plain = F.regexp_replace(lowered, r"[^\p{L}\p{N}]+", " ")
    other = (F.octet_length(lowered) != F.length(lowered)) & F.rlike(lowered, F.lit(f"[^{_KNOWN}]"))
    return F.when(other, plain).otherwise(lowered)


def _parts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each value starts in them and the last ends)."""
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    _, places, held = strings.buffers()
    if not len(strings) or held is None:
        return np.empty(0, np.uint8), np.zeros(len(strings) + 1, np.int64)
    ends = np.frombuffer(places, np.int64 if wide else np.int32)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(held, np.uint8)[ends[0] : ends[-1]], ends.astype(np.int64) - ends[0]


def _in_tokens(text: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a letter or a digit."""
    inside = _BYTES[text]
    if not len(text) or text.max() < 0x80:
        return inside
    at = np.flatnonzero((text >= 0xC2) & (text <= 0xC9))  # U+0080 to U+027F
    other = at[~_LETTERS[((text[at] & 31).astype(np.int64) << 6) | (text[at + 1] & 63)]]
    inside[other] = inside[other + 1] = False
    at = np.flatnonzero(text == 0xE2)
    second, third = text[at + 1], text[at + 2]
    marks = at[(second == 0x80) | ((second == 0x81) & (third <= 0xAF))]  # U+2000 to U+206F
    inside[marks] = inside[marks + 1] = inside[marks + 2] = False
    return inside


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all tokens in order, how many each text has)."""
    text, ends = _parts(texts)
    inside = _in_tokens(text)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = ends[1:] > ends[:-1]
    opens, closes = ends[:-1][filled], ends[1:][filled] - 1
    first[opens], last[closes] = inside[opens], inside[closes]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(text[inside])]
    )
    return words, np.diff(np.searchsorted(starts, ends))


def _digest_heads(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first word of MD5 of strings of at most 55 bytes, whose digest is that of one block."""
    n, sizes = len(ends) - 1, np.diff(ends)
    padded = np.zeros((n, 64), np.uint8)
    padded.ravel()[np.arange(ends[-1] - ends[0]) + np.repeat(np.arange(n) * 64 - (ends[:-1] - ends[0]), sizes)] = text[ends[0] : ends[-1]]
    padded[np.arange(n), sizes] = 0x80
    message = np.ascontiguousarray(padded.view("<u4").T)
    message[14] = sizes * 8
    used = {*range(int(sizes.max()) // 4 + 1), 14}  # the others are zero
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, g = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif i < 32:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        f += a
        f += _SINES[i]
        if _PLACES[i] in used:
            f += message[_PLACES[i]]
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=g)
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=f)
        f |= g
        np.add(b, f, out=a)
        a, b, c, d = d, a, b, c
    return a + np.uint32(_START[0])


def digest_heads(words: pa.Array) -> np.ndarray:
    """The first four bytes of the MD5 of each string, as a number."""
    found = np.empty(len(words), np.uint32)
    for start in range(0, len(words), BLOCK_WORDS):
        part = words.slice(start, BLOCK_WORDS)
        text, ends = _parts(part)
        sizes, heads = np.diff(ends), found[start : start + len(part)]
        if sizes.max() <= 55:
            heads[:] = _digest_heads(text, ends).astype("<u4").byteswap()
            continue
        short = sizes <= 55
        if short.any():
            heads[short] = digest_heads(part.filter(pa.array(short)))
        for i in np.flatnonzero(~short):
            heads[i] = int.from_bytes(md5(part[i].as_py()).digest()[:4])
    return found


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of bounded rows and bytes, or of one text."""
    start, ends = 0, _parts(texts)[1]
    while start < len(texts):
        fits = int(np.searchsorted(ends, ends[start] + BLOCK_BYTES, "right")) - 1
        stop = min(max(fits, start + 1), start + BLOCK_TEXTS, len(texts))
        yield texts.slice(start, stop - start)
        start = stop


def bucket_counts(texts: pa.Array, dim: int) -> np.ndarray:
    """How many tokens of each text fall into each of ``dim`` buckets."""
    words, each = _tokens(texts)
    coded = words.dictionary_encode()
    place = digest_heads(coded.dictionary).astype(np.int64) % dim
    cells = np.repeat(np.arange(len(texts)) * dim, each) + place[coded.indices.to_numpy()]
    return np.bincount(cells, minlength=len(texts) * dim).reshape(len(texts), dim)


def unit_counts(texts: pa.Array, dim: int) -> np.ndarray:
    """The counts scaled to length one, text after text; a text without a token or null has zeros."""
    parts = [np.empty(0, np.float32)]
    for block in blocks(pc.fill_null(texts, "")):
        counts = bucket_counts(block, dim).astype(np.float64)
        norms = np.sqrt(np.einsum("ij,ij->i", counts, counts))
        parts.append((counts / np.where(norms == 0, 1, norms)[:, None]).astype(np.float32).ravel())
    return np.concatenate(parts)
