"""Language identification by language-bitmask n-gram filters.

Trigrams of characters (lower-cased, everything but letters a blank, a letter in the
middle) are counted per language over all labelled training texts.  A language
*contains* a trigram if its share of the language's trigrams is at least ``ratio`` of
the largest share that any language gives it, so strays of mixed texts drop out.  All
trigrams that a language contains enter the model, whatever its alphabet; ``most`` bounds the bytes of
the model of all languages, beyond which the trigrams with the smallest shares are left out.

The model is a bit-sliced Bloom filter: a slot holds one bit per language, and ANDing
the ``HASHES`` slots of a trigram returns all languages that contain it at once.  For a
text, bits are counted per language; the count is corrected for false positives, whose
rate per language is the filled share of its slice to the power of ``HASHES``.  The
language with the highest corrected share of the text's trigrams wins (of equal ones the
first by name), and that share is the score.

Counting is a map-side sum over a bounded number of counts followed by a shuffle of sums.
Prediction reads each text once in the task that scans it; only the bounded model is
broadcast, with its rates.  Texts are worked on in small pieces, as a byte takes many of arrays.

A null text or one without a letter is ``und`` with score 0.  A text none of whose
trigrams is known gets the most frequent training language with score 0.  Without
training texts everything is ``und``.  Rows with a null label don't train; repeated
rows count and are predicted one by one.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from passagelake.llm.common import pieces

HASHES = 3
#: Bytes of text worked on at once; each takes some hundred bytes of arrays.
PIECE = 1 << 18
#: Counts that a task gathers before it sums them up and passes them on.
GATHERED = 1 << 19
UNKNOWN = "und"
COUNTS = "lang string, gram long, n long"
#: Odd multipliers of the two hashes of a trigram.
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def letters_only(points: np.ndarray) -> np.ndarray:
    """Code points, with a blank for each that is not a letter."""
    table = np.zeros(int(points.max(initial=0)) + 1, np.uint32)
    table[points] = 1
    for i in np.flatnonzero(table).tolist():
        table[i] = i if chr(i).isalpha() else 32
    return table[points]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of all texts, and where those of each text begin (and end)."""
    lowered = [f" {(t or '').lower()} " for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    points = letters_only(np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")).astype(np.uint64)
    middle = np.flatnonzero(points != 32)
    codes = points[middle - 1] << np.uint64(42) | points[middle] << np.uint64(21) | points[middle + 1]
    return codes, np.searchsorted(middle, np.concatenate([[0], np.cumsum(sizes)]))


def _summed(gathered: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    """One row per language and trigram of what was gathered."""
    for lang, parts in sorted(gathered.items()):
        grams, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(grams, kind="stable")
        grams = grams[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        sums = np.add.reduceat(n[order], first)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(first), pa.string()), pa.array(grams[first].astype(np.int64)), pa.array(sums)],
            names=["lang", "gram", "n"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gathered, size = {}, 0
    for batch in batches:
        for part in pieces(batch, size=PIECE):
            langs = np.array(part["lang"].to_pylist(), object)
            codes, bounds = trigrams(part["text"].to_pylist())
            owner = np.repeat(np.arange(len(langs)), np.diff(bounds))
            for lang in sorted(set(langs)):
                found = np.unique(codes[(langs == lang)[owner]], return_counts=True)
                if len(found[0]):
                    gathered.setdefault(lang, []).append(found)
                    size += len(found[0])
            if size > GATHERED:
                yield from _summed(gathered)
                gathered, size = {}, 0
    yield from _summed(gathered)


@dataclass
class LanguageModel:
    """``slots[w, j]``: bits of languages 64 w to 64 w + 63 in slot j."""

    languages: list[str]
    fallback: str
    slots: np.ndarray
    rates: np.ndarray | None = None

    def __post_init__(self):
        if self.rates is None:
            self.rates = self.false_rates()

    @classmethod
    def of(cls, languages: list[str], fallback: str, lang: np.ndarray, gram: np.ndarray) -> LanguageModel:
        """From pairs of a language's number and a trigram that it contains."""
        size = 1 << max(10, (12 * len(gram)).bit_length())
        slots = np.zeros((-(-len(languages) // 64) or 1, size), np.uint64)
        for place in _places(gram.astype(np.uint64), size):
            np.bitwise_or.at(slots, (lang // 64, place), np.uint64(1) << (lang % 64).astype(np.uint64))
        return cls(languages, fallback, slots)

    def false_rates(self) -> np.ndarray:
        """Chance that a trigram no language contains passes as one of each language."""
        filled = [
            np.count_nonzero(self.slots[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / self.slots.shape[1]
            for i in range(len(self.languages))
        ]
        return np.array(filled) ** HASHES

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each text's trigrams in each language; letters per text."""
        codes, bounds = trigrams(texts)
        places = list(_places(codes, self.slots.shape[1]))
        counts, n = np.zeros((len(texts), len(self.languages))), np.diff(bounds)
        for w, words in enumerate(self.slots):
            bits = words[places[0]]
            for place in places[1:]:
                bits &= words[place]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                sums = np.concatenate([[0], np.cumsum(bits >> np.uint64(i % 64) & np.uint64(1))])
                counts[:, i] = sums[bounds[1:]] - sums[bounds[:-1]]
        rates = self.rates
        return np.clip((counts / np.maximum(n, 1)[:, None] - rates) / np.maximum(1 - rates, 1e-9), 0, 1), n

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        shares, n = self.shares(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = shares.argmax(axis=1)
        score = np.where(n > 0, shares[np.arange(len(texts)), best], 0.0)
        names = [
            UNKNOWN if not k else self.languages[b] if s > 0 else self.fallback
            for k, b, s in zip(n, best, score, strict=True)
        ]
        return names, score


def _places(codes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    first, second = codes * MIX[0], codes * MIX[1] | np.uint64(1)
    shift = np.uint64(64 - (size.bit_length() - 1))
    for i in range(HASHES):
        yield ((first + np.uint64(i) * second) >> shift).astype(np.int64)


def train(texts: DataFrame, most: int = 1 << 21, ratio: float = 0.3) -> LanguageModel:
    """The model of ``texts (text, lang)``."""
    texts = texts.select("text", "lang").where("text is not null and lang is not null")
    counts = texts.mapInArrow(_count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    shares = counts.join(totals, "lang").select("lang", "gram", "n", "total", share.alias("share"))
    largest = shares.groupBy("gram").agg(F.max("share").alias("largest"))
    held = shares.join(largest, "gram").where(F.col("share") >= ratio * F.col("largest"))
    table = held.orderBy(F.desc("share"), "lang", "gram").limit(most).select("lang", "gram", "total").toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    number = {lang: i for i, lang in enumerate(languages)}
    total = dict(zip(table["lang"].to_pylist(), table["total"].to_pylist(), strict=True))
    fallback = max(languages, key=lambda lang: (total[lang], lang), default=UNKNOWN)
    lang = np.array([number[x] for x in table["lang"].to_pylist()], np.int64)
    return LanguageModel.of(languages, fallback, lang, table["gram"].to_numpy())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs``' columns but ``text``, with ``lang_pred`` and ``score``."""
    return _mapped(docs, model, keep_text=False)


def with_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added."""
    return _mapped(docs, model, keep_text=True)


def _mapped(docs: DataFrame, model: LanguageModel, keep_text: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.fallback, model.slots, model.rates))
    rest = [c for c in docs.columns if keep_text or c != "text"]
    schema = docs.select(*rest).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*sent.value)
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                names, score = own.predict(part["text"].to_pylist())
                columns = [part[c] for c in rest]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names, pa.string()), pa.array(score)], names=[*rest, "lang_pred", "score"]
                )

    return docs.mapInArrow(apply, schema)


def held_out(fold: Column) -> Column:
    """The rows kept from training, given crc32 of the doc_id as text."""
    return F.coalesce(fold % 3 == 1, F.lit(False))
