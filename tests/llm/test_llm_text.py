"""Decontamination, language identification and the class model."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from conftest import edge_texts, prose, rows_of
from passagelake.llm import class_lm, decontaminate, language_id
from passagelake.llm.common import crc32_of


def normal(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def shingles(words):
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def expected_leaks(docs, items):
    out = {}
    for item, text in items:
        w = normal(text)
        if not w:
            continue
        own = shingles(w)
        for doc, body in docs:
            d = normal(body)
            if not d:
                continue
            for start in range(-len(w), len(d)):
                window = d[max(start, 0) : max(start + len(w), 0)]
                if not window:
                    continue
                got = shingles(window)
                alike = (own & got).total() / (own | got).total()
                if alike >= 0.8:
                    out[doc, item] = max(out.get((doc, item), 0), round(alike, 9))
    return out


def test_decontamination(spark, documents, nothing):
    item, other = prose(50, 45), prose(51, 30)
    changed = item.split()
    changed[20] = "different"
    moved = item.split()
    moved[1] = "different"
    rows = [
        (1, prose(52, 80) + " " + item.upper() + "%%% " + prose(53, 20)),
        (2, prose(54, 7) + "\n" + " ".join(changed)), (3, " ".join(moved) + " " + prose(55, 60)), (4, prose(56, 200)),
        (5, None), (6, ""), (7, item[: len(item) // 2]), (8, other + " " + item + " " + other), (8, other), (9, "few words"),
        (None, item),
    ]
    items = [(1, item), (2, other), (2, other), (3, None), (4, "??"), (5, "few words"), (None, prose(57, 25))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, bench)
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found.collect()}
    assert got == expected_leaks(rows, items)
    assert {(1, 1), (3, 1), (8, 1), (8, 2), (9, 5), (None, 1)} <= set(got) and (4, 1) not in got
    assert decontaminate.contaminated(nothing, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(documents, bench).count() == 0


def test_short_items_inside_longer_texts(spark):
    rows = [
        (1, prose(58, 30) + " Few, words! " + prose(59, 30)), (2, "few other words"), (3, "a few words"), (4, "four whole words here so few"),
        (5, "it has four whole words here"), (6, "few words few words"), (7, "lone"),
    ]
    items = [(1, "few words"), (2, "four whole words here"), (3, "lone"), (4, prose(60, 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity) for r in found.collect()}
    assert got == {
        (1, 1): (30, 2, 1.0), (3, 1): (1, 2, 1.0), (4, 2): (0, 4, 1.0), (5, 2): (2, 4, 1.0), (6, 1): (0, 2, 1.0), (7, 3): (0, 1, 1.0),
    }


def test_blocks_find_all_pairs_within_the_radius(spark):
    chooser = np.random.default_rng(3)
    prints = [int(x) for x in chooser.integers(-(2**62), 2**62, 12)]
    asked = [(f"{k}/{d}", p ^ sum(1 << int(b) for b in chooser.choice(63, d, replace=False)))
             for k, p in enumerate(prints) for d in (0, 5, 11, 12, 20)]
    windows = spark.createDataFrame(asked, "window string, fp long")
    items = spark.createDataFrame(list(enumerate(prints)), "item long, item_fp long")
    found = decontaminate.near_pairs(windows, items, 11, 4)
    want = {(w, k) for w, f in asked for k, p in enumerate(prints) if ((f ^ p) & (2**64 - 1)).bit_count() <= 11}
    assert {(r.window, r.item) for r in found.collect()} == want


LETTERS = {"aa": "abcde ", "bb": "defgh ", "cc": "nñopé "}


def made_up(lang, seed, n=300):
    import random

    return "".join(random.Random(f"{lang}{seed}").choices(LETTERS[lang], k=n))


def test_language(spark, nothing):
    rows = [(lang, made_up(lang, s)) for lang in LETTERS for s in range(20)]
    training = spark.createDataFrame([*rows, (None, "aaaa"), ("aa", None)], "lang string, text string")
    model = language_id.train(training)
    assert model.languages == ["aa", "bb", "cc"] and (model.false_rates() < 0.05).all()
    asked = [(k, lang, made_up(lang, 1000 + k)) for k, lang in enumerate(list(LETTERS) * 5)]
    asked += [(90, "und", None), (91, "und", ""), (92, "und", "12 --"), (93, None, "中文 текст"), (94, None, "x")]
    docs = spark.createDataFrame(asked, "doc_id long, want string, text string").withColumn("score2", F.lit(1))
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert len(got) == len(asked)
    for k, want, _ in asked:
        assert 0 <= got[k].score <= 1
        assert got[k].lang_pred == (want or model.fallback)
    none = language_id.train(nothing)
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.identify(nothing.select("doc_id", "text"), model).count() == 0


def test_more_languages_than_a_word_has_bits():
    gram = np.arange(70) << 21
    model = language_id.LanguageModel.of([f"{i:02}" for i in range(70)], "00", np.arange(70), gram + (97 << 42))
    assert model.slots.shape[0] == 2


@pytest.mark.parametrize("options", [{}, {"frequent": 4, "classes": 2, "core": 0.1}])
def test_class_model(documents, options):
    rows = edge_texts()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(i, [*(t or "").encode().lower().split(), b" "]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    total, distinct = counts.total(), len(counts)
    scored = class_lm.score_texts(documents, class_lm.held_out(), **options)
    got = rows_of(scored, "doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6))
    base = lambda ws: sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
    want = sorted(((i, len(ws), sum(counts[w] > 0 for w in ws), total, round(base(ws), 6)) for i, ws in tokens), key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])
    assert all(r.score < 0 for r in scored.collect())


def trained(spark, texts, **options):
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model = class_lm.train(df, class_lm.word_counts(df), **options)
    lex = model.lexicon
    rare = {bytes(r.word): (r["class"], r.n) for r in model.rare.collect()}
    of = {w: (int(model.classes[i]), int(lex.counts[i])) for i, w in enumerate(lex.words.value)}
    return model, of, rare


@pytest.mark.parametrize("options", [{"frequent": 30, "classes": 4}, {"frequent": 12, "classes": 3, "core": 0.2}, {"classes": 4}])
def test_class_probabilities_add_up(spark, options):
    texts = [prose(s, 60) for s in range(40)]
    model, of, rare = trained(spark, texts, **options)
    classes = options["classes"]
    counts = Counter(w for t in texts for w in t.lower().encode().split())
    # Every training word has one class and its own count.
    assert of.keys() | rare.keys() == counts.keys() and not of.keys() & rare.keys()
    assert all(n == counts[w] and 0 <= c < classes for w, (c, n) in (of | rare).items())
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    for c in range(classes):
        mass = sum((n + 0.5) / (model.totals[c] + 0.5 * model.distinct[c]) for k, n in (of | rare).values() if k == c)
        assert mass == pytest.approx(1) or not any(k == c for k, _ in (of | rare).values())


def test_transitions_and_scores_by_counting(spark):
    """The transitions are the counts of histories and classes; a text's score is the sum over its tokens."""
    texts = [prose(s, 50) for s in range(30)] + ["", None, "once only here", "a a a"]
    model, of, rare = trained(spark, texts, frequent=15, classes=4)
    both, end, other, size = of | rare, 5, 4, 6
    follow = np.zeros((size, size))
    for t in texts:
        history = end
        for w in (t or "").lower().encode().split():
            follow[history, both[w][0]] += 1
            follow[history, other] += both[w][1] == 1
            history = of[w][0] if w in of else other
        follow[history, end] += 1
    share = (follow.sum(axis=0) + 1) / (follow.sum(axis=0) + 1).sum()
    want = np.log10((follow + class_lm.PRIOR * share) / (follow.sum(axis=1, keepdims=True) + class_lm.PRIOR))
    assert np.allclose(model.transitions, want)
    assert model.unseen == 1 + sum(n == 1 for _, n in both.values())
    asked = [(1, texts[0]), (2, "never seen " + texts[3]), (3, None), (4, "Once ONLY unheard unheard"), (None, texts[1])]
    scored = class_lm.score(spark.createDataFrame(asked, "doc_id long, text string"), model)
    got = {r.doc_id: r.score for r in scored.collect()}
    for i, t in asked:
        history, total = end, 0.0
        for w in (t or "").lower().encode().split():
            if w in both:
                c, n = both[w]
                total += want[history, c] + math.log10((n + 0.5) / (model.totals[c] + 0.5 * model.distinct[c]))
            else:
                total += want[history, other] - math.log10(model.unseen)
            history = of[w][0] if w in of else other
        assert got[i] == pytest.approx(total + want[history, end])


def test_rare_words_join_the_class_of_their_contexts(spark):
    """Rare words that stand where words of one kind stand get its class."""
    import random

    chooser, texts = random.Random(3), []
    for k in range(200):
        words = []
        for _ in range(20):
            words += [chooser.choice(["a", "b", "c", f"first{chooser.randrange(60)}"]), chooser.choice(["x", "y", "z", f"second{chooser.randrange(60)}"])]
        texts.append(" ".join(words))
    _, of, rare = trained(spark, texts, frequent=6, classes=2, core=0.1)
    kinds = {of[w][0] for w in (b"a", b"b", b"c")}, {of[w][0] for w in (b"x", b"y", b"z")}
    assert sorted(map(sorted, kinds)) == [[0], [1]]
    for w, (c, _) in rare.items():
        assert c in kinds[w.startswith(b"second")], w


def test_exchange_finds_alternating_classes(spark):
    """Words of two kinds that always alternate."""
    import random

    chooser = random.Random(2)
    texts = [(" ".join(chooser.choice(("a", "b", "c")) + " " + chooser.choice(("x", "y", "z")) for _ in range(40)),) for _ in range(30)]
    df = spark.createDataFrame(texts, "text string").cache()
    lex = class_lm.lexicon(class_lm.word_counts(df), 30, 6)
    numbers = np.arange(8)
    pairs = class_lm.pair_counts(df, lex, numbers, numbers)
    found = class_lm.exchange(pairs, 6, 2, 20)
    kinds = defaultdict(set)
    for word, c in zip(lex.words.value, found, strict=False):
        kinds[int(c)].add(word.decode())
    assert sorted(map(sorted, kinds.values())) == [["a", "b", "c"], ["x", "y", "z"]]


def test_scores_on_no_training_text(documents, nothing):
    assert class_lm.score_texts(nothing, class_lm.held_out()).count() == 0
    scored = class_lm.score_texts(documents, F.lit(True)).collect()
    assert len(scored) == len(edge_texts()) and {r.train_tokens for r in scored} == {0}


def test_crc_of_ids(spark):
    row = spark.range(12, 13).select(crc32_of("id").alias("c")).first()
    assert row.c == zlib.crc32(b"12")


def test_language_shares_by_counting(spark):
    """Every contained trigram is in the model; corrected shares are near the counted ones."""
    alphabets = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "".join(map(chr, range(0x4E00, 0x4E00 + 60)))}
    import random

    chooser = random.Random(6)
    make = lambda lang, n: " ".join("".join(chooser.choice(alphabets[lang]) for _ in range(4)) for _ in range(n))
    rows = [(make(lang, 200), lang) for lang in alphabets for _ in range(40)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))

    def grams(text):
        t = f" {text} "
        return [t[i - 1 : i + 2] for i in range(1, len(t) - 1) if t[i] != " "]

    counted = {lang: Counter(g for t, k in rows if k == lang for g in grams(t)) for lang in alphabets}
    share = {lang: {g: n / c.total() for g, n in c.items()} for lang, c in counted.items()}
    held = {
        lang: {g for g, x in share[lang].items() if x >= 0.3 * max(share[k].get(g, 0) for k in share)} for lang in share
    }
    assert len(held["cc"]) > 1 << 14  # a large alphabet loses nothing
    asked = [make(lang, 50) for lang in alphabets for _ in range(5)] + ["gh hg", "abch " + make("cc", 3)]
    shares, _ = model.shares(asked)
    for text, got in zip(asked, shares, strict=True):
        own = grams(text)
        want = [sum(g in held[lang] for g in own) / len(own) for lang in model.languages]
        assert np.allclose(got, want, atol=0.12), (text, got, want)
    whole = spark.createDataFrame([(i, t) for i, t in enumerate(asked[:15])], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language_id.identify(whole, model).collect()}
    assert found == {i: list(alphabets)[i // 5] for i in range(15)}
    small = language_id.train(spark.createDataFrame(rows, "text string, lang string"), most=50)
    assert small.shares(asked)[0].sum() < shares.sum()


def test_more_partitions_than_words(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        model, of, rare = trained(spark, ["a b a c", "d a b"], frequent=2, classes=2, core=0.1)
        assert set(of) | set(rare) == {b"a", b"b", b"c", b"d"} and np.allclose((10**model.transitions).sum(axis=1), 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def labelled(n, words):
    texts = [None, "", "12", *(prose(s, words) + " Été 中文" for s in range(n))]
    langs = [("en", "fr", "de")[k % 3] for k in range(len(texts))]
    return pa.RecordBatch.from_arrays([pa.array(texts), pa.array(langs)], names=["text", "lang"])


@pytest.mark.parametrize("gathered", [1, 500, 1 << 19])
def test_trigrams_of_pieces_are_summed(monkeypatch, gathered):
    monkeypatch.setattr(language_id, "PIECE", 300)
    monkeypatch.setattr(language_id, "GATHERED", gathered)
    batch, want, got = labelled(30, 20), Counter(), Counter()
    for text, lang in zip(*(batch[c].to_pylist() for c in ("text", "lang")), strict=True):
        line = f" {''.join(c if c.isalpha() else ' ' for c in (text or '').lower())} "
        for i in range(1, len(line) - 1):
            a, b, c = map(ord, line[i - 1 : i + 2])
            want[lang, a << 42 | b << 21 | c] += b != 32
    found = list(language_id._count(iter([batch, batch.slice(0, 0), batch])))
    for part in found:
        for lang, gram, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
            got[lang, gram] += n
    assert got == Counter({k: 2 * n for k, n in want.items() if n})
    assert gathered < 1 << 19 or sum(b.num_rows for b in found) == len(got)
    assert not list(language_id._count(iter([batch.slice(0, 3)])))


def test_language_of_a_large_batch_takes_little_memory():
    """Arrays are those of a piece, not of some megabytes of text."""
    batch = labelled(60, 8_000)
    assert batch.nbytes > 2 << 20
    tracemalloc.start()
    rows = list(language_id._count(iter([batch])))
    counting = tracemalloc.get_traced_memory()[1]
    model = language_id.LanguageModel.of(["en"], "en", np.zeros(len(rows[0]), np.int64), rows[0]["gram"].to_numpy())
    tracemalloc.reset_peak()
    scores = [model.predict(part["text"].to_pylist())[1] for part in language_id.pieces(batch, size=language_id.PIECE)]
    predicting = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, scores)) == batch.num_rows
    assert counting < 40 << 20 and predicting < 40 << 20
