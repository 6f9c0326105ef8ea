"""Scores of texts under a Brown class-based bigram model.

The model gives a token the probability P(class | history) P(token | class), from relative
frequencies over all training texts.  Every training word has a class.

* *Counts.*  Tokens are words (runs without blanks, A-Z lower-cased) and one end per text.
  Every training word is counted in a shuffled table.
* *Exchange.*  The most frequent words that make up the share ``core`` of the training words are
  clustered by exchange: from a table of their bigrams, each sweep works out for every word, in
  parallel, which class would raise the likelihood of the class bigrams most; so that words which
  attract each other don't swap for ever, a sweep moves a (reproducible) random half of them.  Sweeps
  end when the likelihood has stopped to gain ``tolerance`` of itself; the best classes count.
* *Placing.*  Each other word takes the class that suits its neighbours best: words of the lexicon by
  the exchange's own measure, all rarer ones by the likelihood of their contexts, which
  meet by word in one shuffle and stream past.
* *History.*  A word's history is the class of the word before; words outside the lexicon (the
  ``frequent`` first words, which are broadcast) are one history class.  The end is a class of its own.
* *Smoothing.*  Transitions are mixed with the share of the class that follows; words have half a count
  more.  Unseen words are a class, as frequent after a history as words that were seen
  once, and as many as those.
* *Scoring.*  Words outside the lexicon meet their class and count by a join, and a text's sums come
  together by a shuffle of sums.

What grows with the corpus is shuffled; what is broadcast or collected is bounded by the
parameters: the lexicon, and counts between classes.

Null texts count as empty: they are an end alone.  Rows with a null doc_id train.
Repeated rows train and are scored one by one.  With no training text, every token has
the probability of an unseen word.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagelake.llm.common import Words, crc32_of, pieces, stored

#: Frequent words longer than this many bytes are left to the join.
LONGEST = 64
#: Sweeps without a gain after which exchange ends.
PATIENCE = 2
#: Bytes of texts that are taken apart at once.
PIECE = 1 << 20
#: Weight of the class shares in a class's transitions, in counts.
PRIOR = 5.0


@dataclass
class Lexicon:
    """The most frequent words by falling count, as a broadcast; what all tasks number words by.

    Numbers: words 0 to ``size`` - 1, then any other word, then the end of a text.
    """

    words: object
    counts: np.ndarray
    total: int
    distinct: int
    texts: int

    @property
    def size(self) -> int:
        return len(self.counts)

    @property
    def other(self) -> int:
        return self.size

    @property
    def end(self) -> int:
        return self.size + 1


def _numbered(part: pa.RecordBatch, known: dict[bytes, int], other: int, end: int) -> tuple[Words, np.ndarray]:
    """A piece's words, and the numbers of its tokens: each text's words, then the end."""
    words = Words(part["text"], lower=True)
    numbers = np.array([known.get(w, other) for w in words.vocabulary] or [other], np.int64)
    return words, np.insert(numbers[words.ids], words.starts[1:], end)


def _before(tokens: np.ndarray, end: int) -> np.ndarray:
    """What precedes each token; before a text's first one comes an end."""
    return np.concatenate([[end], tokens[:-1]])


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` of all words of ``texts (text)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                words = Words(part["text"], lower=True)
                n = np.bincount(words.ids, minlength=len(words.vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.vocabulary, pa.binary()), pa.array(n, pa.int64())], names=["word", "n"]
                )

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame, texts: int, frequent: int) -> Lexicon:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    first = counts.where(F.octet_length("word") <= LONGEST).orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    sent = counts.sparkSession.sparkContext.broadcast(first["word"].to_pylist())
    return Lexicon(sent, first["n"].to_numpy().astype(np.int64), total + texts, distinct + (texts > 0), texts)


def pair_counts(texts: DataFrame, words: Lexicon, left: np.ndarray, right: np.ndarray) -> DataFrame:
    """``(a, b, n)``: neighbouring tokens, numbered anew by ``left`` and ``right``.

    Both map the lexicon's numbers; pairs with a negative one are left out.
    """
    sent, other, end = words.words, words.other, words.end
    span = int(right.max()) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: i for i, w in enumerate(sent.value)}
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                _, tokens = _numbered(part, known, other, end)
                a, b = left[_before(tokens, end)], right[tokens]
                code, n = np.unique((a * span + b)[(a >= 0) & (b >= 0)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code // span), pa.array(code % span), pa.array(n)], names=["a", "b", "n"]
                )

    found = texts.select("text").mapInArrow(count, "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _dense(pairs: DataFrame, size: int) -> np.ndarray:
    """Counts between classes, bounded by their number."""
    table, matrix = pairs.toArrow(), np.zeros((size, size))
    matrix[table["a"].to_numpy(), table["b"].to_numpy()] = table["n"].to_numpy()
    return matrix


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(
    matrix: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray, now: np.ndarray, classes: int
) -> np.ndarray:
    """For each word the class (below ``classes``) that makes the class bigrams likeliest.

    ``matrix`` counts class bigrams with each word in class ``now`` (nowhere, if
    negative); a row of ``right`` and ``left`` counts the classes after and before a word
    other than the word itself, ``own`` how often it follows itself.  A word leaves its
    class only for a better one.
    """
    each, some = np.arange(len(now)), np.flatnonzero(now >= 0)
    m = np.repeat(matrix[None], len(now), axis=0)
    m[some, now[some]] -= right[some]
    m[some, :, now[some]] -= left[some]
    m[some, now[some], now[some]] -= own[some]
    part, c = _xlogx(m), np.arange(classes)
    row = m[:, :classes] + right[:, None, :]
    row[:, c, c] += left[:, :classes] + own[:, None]
    column = _xlogx(m + left[:, :, None])[:, :, :classes]
    rows, columns = m.sum(axis=2)[:, :classes], m.sum(axis=1)[:, :classes]
    after, before = (right.sum(axis=1) + own)[:, None], (left.sum(axis=1) + own)[:, None]
    gain = (
        _xlogx(row).sum(axis=2) - part[:, :classes].sum(axis=2)
        + column.sum(axis=1) - column[:, c, c] - part[:, :, :classes].sum(axis=1) + part[:, c, c]
        - _xlogx(rows + after) + _xlogx(rows) - _xlogx(columns + before) + _xlogx(columns)
    )
    best = gain.argmax(axis=1)
    stay = some[gain[some, now[some]] >= gain[each, best][some] - 1e-9]
    best[stay] = now[stay]
    return best


def _choices(sides: DataFrame, matrix: np.ndarray, now: np.ndarray, classes: int) -> np.ndarray:
    """``(word, class)`` that suit best, from ``sides (word, side, class, n)``.

    Side 0 counts classes after the word, 1 those before it, 2 the word itself.
    """
    size = len(matrix)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # of a share of the lexicon's words
        if not held:
            return
        table = pa.Table.from_batches(held)
        words, index = np.unique(table["word"].to_numpy(), return_inverse=True)
        contexts = np.zeros((len(words), 3, size))
        np.add.at(contexts, (index, table["side"].to_numpy(), table["class"].to_numpy()), table["n"].to_numpy())
        for start in range(0, len(words), 512):
            some = words[start : start + 512]
            after, before, own = contexts[start : start + 512].transpose(1, 0, 2)
            chosen = best_classes(matrix, after, before, own.sum(axis=1), now[some], classes)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(chosen)], names=["word", "class"])

    found = sides.groupBy("word", "side", "class").agg(F.sum("n").alias("n")).repartition("word")
    table = found.mapInArrow(choose, "word long, class long").toArrow()
    return np.stack([table["word"].to_numpy(), table["class"].to_numpy()], axis=1)


def _sides(spark: SparkSession, pairs: DataFrame, classes: np.ndarray, words: int) -> DataFrame:
    """``(word, side, class, n)`` of the first ``words`` words of bigrams ``(a, b, n)``."""
    of = F.broadcast(spark.createDataFrame([(i, int(c)) for i, c in enumerate(classes)], "id long, class long"))
    other = F.col("a") != F.col("b")
    after = pairs.where(other & (F.col("a") < words)).join(of, F.col("b") == F.col("id"))
    before = pairs.where(other & (F.col("b") < words)).join(of, F.col("a") == F.col("id"))
    own = pairs.where(~other & (F.col("a") < words))
    return (
        after.select(F.col("a").alias("word"), F.lit(0).alias("side"), "class", "n")
        .union(before.select(F.col("b").alias("word"), F.lit(1).alias("side"), "class", "n"))
        .union(own.select(F.col("a").alias("word"), F.lit(2).alias("side"), F.lit(0).alias("class"), "n"))
    )


def likelihood(matrix: np.ndarray) -> float:
    """The log likelihood of class bigrams, but for what doesn't depend on classes."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(axis=0)).sum() - _xlogx(matrix.sum(axis=1)).sum())


def exchange(pairs: DataFrame, words: int, classes: int, sweeps: int, tolerance: float = 1e-4) -> np.ndarray:
    """Classes of the ``words`` first words, then those of all others and of the end.

    ``pairs (a, b, n)`` counts bigrams of the words, numbered from 0, with ``words`` for
    any other and ``words + 1`` for the end.
    """
    spark = pairs.sparkSession
    now = np.concatenate([np.arange(words) % classes, [classes, classes + 1]])
    best, reached, idle = now.copy(), -np.inf, 0
    for sweep in range(sweeps):
        of = spark.createDataFrame([(i, int(c)) for i, c in enumerate(now)], "id long, class long")
        matrix = _dense(_by_class(pairs, of), classes + 2)
        gained = likelihood(matrix)
        # Words that move at once can be in each other's way: a few sweeps may pass without a gain.
        idle = 0 if sweep == 0 or gained - reached >= tolerance * abs(reached) else idle + 1
        if gained > reached:
            best, reached = now.copy(), gained
        if idle == PATIENCE:
            break
        chosen = _choices(_sides(spark, pairs, now, words), matrix, now, classes)
        better = chosen[now[chosen[:, 0]] != chosen[:, 1]]
        if not len(better):
            return best
        mine = better[np.random.default_rng(sweep).random(words)[better[:, 0]] < 0.5]
        now[mine[:, 0]] = mine[:, 1]
    return best


def _by_class(pairs: DataFrame, of: DataFrame) -> DataFrame:
    first = F.broadcast(of.select(F.col("id").alias("a"), F.col("class").alias("ca")))
    second = F.broadcast(of.select(F.col("id").alias("b"), F.col("class").alias("cb")))
    return pairs.join(first, "a").join(second, "b").groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(
        F.sum("n").alias("n")
    )


def lexicon_contexts(texts: DataFrame, words: Lexicon, first: int, of: np.ndarray) -> DataFrame:
    """``(word, side, class, n)``: classes beside the lexicon's words from number ``first`` on.

    Side 0 counts classes after the word, 1 those before it.
    """
    sent, other, end, span = words.words, words.other, words.end, int(of.max()) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: i for i, w in enumerate(sent.value)}
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                _, tokens = _numbered(part, known, other, end)
                previous = _before(tokens, end)
                code = np.concatenate([
                    np.where((previous >= first) & (previous < other), previous * 2 * span + of[tokens], -1),
                    np.where((tokens >= first) & (tokens < other), (tokens * 2 + 1) * span + of[previous], -1),
                ])
                code, n = np.unique(code[code >= 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code // span // 2), pa.array(code // span % 2), pa.array(code % span), pa.array(n)],
                    names=["word", "side", "class", "n"],
                )

    return texts.select("text").mapInArrow(count, "word long, side long, class long, n long")


def rare_contexts(texts: DataFrame, words: Lexicon, of: np.ndarray) -> DataFrame:
    """``(word, before, after, n)``: the histories around every word outside the lexicon.

    Rows whose word begins with a blank, one such word a task, count the lexicon's tokens and ends
    instead, by history and by class; those that are seen once count for the unseen (the class of
    ``other``), too.
    """
    sent, other, end, span = words.words, words.other, words.end, int(of.max()) + 1
    once, unseen = np.append(words.counts == 1, [False, False]), int(of[words.other])

    def rows(names: list, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.binary()), pa.array(code // span % span, pa.int32()), pa.array(code % span, pa.int32()),
                pa.array(n, pa.int64()),
            ],
            names=["word", "before", "after", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, follow = {w: i for i, w in enumerate(sent.value)}, np.zeros(span * span, np.int64)
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                found, tokens = _numbered(part, known, other, end)
                previous, after = of[_before(tokens, end)], of[np.append(tokens[1:], end)]
                seen = tokens != other
                follow += np.bincount(previous[seen] * span + of[tokens[seen]], minlength=span * span)
                follow += np.bincount(previous[once[tokens]] * span + unseen, minlength=span * span)
                # Places of words among the tokens, which hold an end after each text.
                rare = np.flatnonzero(~seen)
                word = found.ids[np.flatnonzero(tokens[tokens != end] == other)]
                code, n = np.unique((word * span + previous[rare]) * span + after[rare], return_counts=True)
                if len(code):
                    vocabulary = pa.array(found.vocabulary, pa.binary())
                    yield rows(vocabulary.take(pa.array(code // (span * span))), code, n)
        code = np.flatnonzero(follow)
        yield rows([b" %d" % TaskContext.get().partitionId()] * len(code), code, follow[code])

    return texts.select("text").mapInArrow(count, "word binary, before int, after int, n long")


def placed_words(contexts: DataFrame, matrix: np.ndarray, classes: int) -> DataFrame:
    """``(word, class, n)`` of every word in ``contexts (word, before, after, n)``: the class that makes
    its contexts likeliest, and its count.

    Rows without a word tell ``class`` of all tokens by history: ``before * size + class``; words seen
    once count for the unseen, too.
    """
    size = classes + 2
    step = (matrix + PRIOR / size) / (matrix + PRIOR / size).sum(axis=1, keepdims=True)
    gain = np.log(np.concatenate([step[:, :classes], step[:classes].T]))  # by history, then by what follows
    weight = np.log(matrix[:, :classes].sum(axis=0) + 1.0)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        follow, held = np.zeros((size, size), np.int64), None

        def chosen(words: list, counts: np.ndarray) -> pa.RecordBatch:
            """The classes of some words, from counts of histories and of what follows."""
            n = counts[:, :size].sum(axis=1)
            best = (counts @ gain - n[:, None] * weight).argmax(axis=1)
            np.add.at(follow.T, best, counts[:, :size])
            follow[:, classes] += counts[n == 1, :size].sum(axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(best, pa.int32()), pa.array(n, pa.int64())], names=["word", "class", "n"]
            )

        for batch in batches:
            task = pc.starts_with(batch["word"], b" ")
            if pc.any(task, min_count=0).as_py():
                known = batch.filter(task)
                np.add.at(follow, (known["before"].to_numpy(), known["after"].to_numpy()), known["n"].to_numpy())
                batch = batch.filter(pc.invert(task))
            coded = batch["word"].dictionary_encode()
            index, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()  # in order of appearance
            if not words:
                continue
            counts = np.zeros((len(words), 2 * size), np.int64)
            n = batch["n"].to_numpy()
            np.add.at(counts, (index, batch["before"].to_numpy()), n)
            np.add.at(counts, (index, size + batch["after"].to_numpy()), n)
            if held and held[0] == words[0]:  # its rows began in the batch before
                counts[0] += held[1]
            elif held:
                yield chosen([held[0]], held[1][None])
            held = words[-1], counts[-1].copy()
            if len(words) > 1:
                yield chosen(words[:-1], counts[:-1])
        if held:
            yield chosen([held[0]], held[1][None])
        code = np.flatnonzero(follow)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(code), pa.binary()), pa.array(code, pa.int32()), pa.array(follow.reshape(-1)[code])],
            names=["word", "class", "n"],
        )

    by_word = contexts.repartition("word").sortWithinPartitions("word")
    return by_word.mapInArrow(place, "word binary, class int, n long")


@dataclass
class ClassModel:
    """``classes`` and ``emissions`` of the lexicon's numbers; ``transitions`` by history and class; log10.

    ``rare (word, class, n)`` are the training words outside the lexicon; ``totals`` and ``distinct`` are
    the tokens and words of each class, ``unseen`` how many words are taken to be unseen.
    """

    lexicon: Lexicon
    classes: np.ndarray
    emissions: np.ndarray
    transitions: np.ndarray
    rare: DataFrame
    totals: np.ndarray
    distinct: np.ndarray
    unseen: int


def train(
    texts: DataFrame, counts: DataFrame, frequent: int = 100_000, core: float = 0.5, classes: int = 24,
    sweeps: int = 30, tolerance: float = 1e-4,
) -> ClassModel:
    """The model of ``texts (text)``, whose word counts are ``counts``."""
    spark, size = texts.sparkSession, classes + 2
    words = lexicon(counts, texts.count(), frequent)
    reach = np.cumsum(words.counts)
    m = min(words.size, max(classes, int(np.searchsorted(reach, core * (words.total - words.texts))) + 1))
    numbers = np.arange(words.size + 2)
    fine = np.where(numbers < m, numbers, m)
    fine[words.end] = m + 1
    pairs = stored(pair_counts(texts, words, fine, fine), "bigrams")
    now = exchange(pairs, m, classes, sweeps, tolerance)
    of = np.full(words.size + 2, classes)
    of[:m], of[words.end] = now[:m], classes + 1
    table = spark.createDataFrame([(i, int(c)) for i, c in enumerate(now)], "id long, class long")
    matrix = _dense(_by_class(pairs, table), size)
    if words.size > m:
        beside = lexicon_contexts(texts, words, m, of)
        chosen = _choices(beside, matrix, np.full(words.size + 2, -1), classes)
        of[chosen[:, 0]] = chosen[:, 1]
    rare = stored(placed_words(rare_contexts(texts, words, of), matrix, classes), "rare-words")
    follows = rare.where("word is null").select(F.expr(f"class div {size}").alias("a"), F.expr(f"class % {size}").alias("b"), "n")
    matrix = _dense(follows.groupBy("a", "b").agg(F.sum("n").alias("n")), size)
    rare = rare.where("word is not null")
    sums = rare.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("once"))
    found = sums.toArrow()  # one row a class
    follow = matrix.sum(axis=0) + 1.0
    share = follow / follow.sum()
    transitions = np.log10((matrix + PRIOR * share) / (matrix.sum(axis=1, keepdims=True) + PRIOR))
    c = np.concatenate([words.counts, [0, words.texts]]).astype(float)
    totals, distinct = np.bincount(of, c, size), np.bincount(of[: words.size], minlength=size).astype(float)
    totals[found["class"].to_numpy()] += found["n"].to_numpy()
    distinct[found["class"].to_numpy()] += found["words"].to_numpy()
    distinct[classes + 1] = 1
    with np.errstate(divide="ignore", invalid="ignore"):
        emissions = np.log10((c + 0.5) / (totals[of] + 0.5 * distinct[of]))
    emissions[words.other] = 0.0
    unseen = int(found["once"].to_numpy().sum()) + int((words.counts == 1).sum()) + 1
    return ClassModel(words, of, emissions, transitions, rare, totals, distinct, unseen)


PARTS = "doc_id long, tie long, word binary, history int, n long, n_tokens long, n_known long, base double, score double"


def score(docs: DataFrame, model: ClassModel) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of ``docs (doc_id, text)``."""
    lex = model.lexicon
    sent, other, end, total = lex.words, lex.other, lex.end, lex.total
    classes, emissions, transitions = model.classes, model.emissions, model.transitions
    scale = total + 0.5 * (lex.distinct + 1)
    c = np.concatenate([lex.counts, [0, lex.texts]])
    bases, seen = np.log10((c + 0.5) / scale), (c > 0).astype(np.int64)
    bases[other] = 0.0  # other words' parts come by the join

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: i for i, w in enumerate(sent.value)}
        names, size = [p.split()[0] for p in PARTS.split(", ")], len(transitions)
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                words, tokens = _numbered(part, known, other, end)
                texts = len(words)
                bounds = words.starts + np.arange(texts + 1)
                history = classes[_before(tokens, end)]
                steps = np.where(tokens == other, 0.0, transitions[history, classes[tokens]] + emissions[tokens])
                base = np.add.reduceat(bases[tokens], bounds[:-1])
                found = np.add.reduceat(seen[tokens], bounds[:-1])
                none = pa.array(np.zeros(texts, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"], part["tie"],
                        # A key of its own, with a blank, that no word has.
                        pa.array([b" %d" % i for i in part["tie"].to_pylist()], pa.binary()),
                        none.cast(pa.int32()), none, pa.array(np.diff(bounds)), pa.array(found),
                        pa.array(base), pa.array(np.add.reduceat(steps, bounds[:-1])),
                    ],
                    names=names,
                )
                rare = tokens == other
                word = words.ids[rare[tokens != end]]
                owner = np.repeat(np.arange(texts), np.diff(bounds))[rare]
                code = (owner * max(1, len(words.vocabulary)) + word) * size + history[rare]
                code, n = np.unique(code, return_counts=True)
                if len(code):
                    pair, before = code // size, code % size
                    owner, word = pair // len(words.vocabulary), pair % len(words.vocabulary)
                    zero, nothing = pa.array(np.zeros(len(code), np.int64)), pa.array(np.zeros(len(code)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["doc_id"].take(pa.array(owner)), part["tie"].take(pa.array(owner)),
                            pa.array(words.vocabulary, pa.binary()).take(pa.array(word)), pa.array(before, pa.int32()),
                            pa.array(n), zero, zero, nothing, nothing,
                        ],
                        names=names,
                    )

    size, unseen = len(transitions), len(transitions) - 2
    keyed = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    of = model.rare.select("word", "class", F.col("n").alias("c"))
    rows = keyed.mapInArrow(sums, PARTS).join(of, "word", "left")
    c, n, rare = F.coalesce("c", F.lit(0)), F.col("n"), F.col("n") > 0
    step = F.get(
        F.array(*[F.lit(float(x)) for x in transitions.reshape(-1)]),
        F.col("history") * size + F.coalesce("class", F.lit(unseen)),
    )
    spread = F.get(F.array(*[F.lit(float(x)) for x in model.totals + 0.5 * model.distinct]), F.col("class"))
    emission = F.when(F.col("class").isNull(), F.lit(-float(np.log10(model.unseen)))).otherwise(F.log10((c + 0.5) / spread))
    base = F.log10((c + 0.5) / scale)
    texts = rows.groupBy("doc_id", "tie").agg(
        F.sum((~rare).cast("int")).alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(rare & (c > 0), n).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(rare, n * base).otherwise(0.0)).alias("base_score"),
        F.sum(F.col("score") + F.when(rare, n * (step + emission)).otherwise(0.0)).alias("score"),
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return texts.select("*", each.alias("copy")).select(
        "doc_id", F.expr("n_tokens div copies").alias("n_tokens"), F.expr("n_known div copies").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"),
    )


def held_out(column: str = "doc_id") -> Column:
    """The documents kept from training."""
    return F.coalesce(crc32_of(column) % 5 == 1, F.lit(False))


def score_texts(docs: DataFrame, held: Column, **options: int) -> DataFrame:
    """Train on the rows of ``docs (doc_id, text)`` that aren't held and score all."""
    training = docs.where(~held).select("text")
    counts = stored(word_counts(training), "word-counts")
    return score(docs, train(training, counts, **options))
