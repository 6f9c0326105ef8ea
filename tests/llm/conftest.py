import random

import pytest

WORDS = [a + b for a in ("ka", "mo", "ri", "tu", "sel") for b in ("na", "ber", "lo", "", "dis", "quo", "x")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"


def prose(seed: int, n: int) -> str:
    chooser = random.Random(seed)
    return " ".join(chooser.choice(WORDS) + chooser.choice(("", "", ",", ".\n")) for _ in range(n))


def edge_texts() -> list[tuple[int | None, str | None]]:
    """(doc_id, text): nulls, empty and long texts, copies, near copies, shared passages."""
    base, passage = prose(1, 120), prose(2, 40)
    return [
        (5, None), (6, ""), (7, " \t\n\x0b\x0c\r "), (8, "one"), (9, "One two"), (10, base),
        (11, base.replace(" ", "\n")), (12, base.replace(" ", "  ") + " "), (13, base + " extra"),
        (14, base.replace("ka", "Ka", 1)), (14, base.replace("ka", "Ka", 1)), (None, base), (None, None),
        (20, passage), (21, prose(3, 30) + " " + passage + " " + prose(4, 30)), (22, prose(5, 9) + " " + passage),
        (23, passage[: len(passage) // 2]), (30, prose(6, 20_000)), (31, "x" * 5_000), (32, "¿Qué? ñandú été\u00a0où 中文"),
        (33, "12 34 !! 56"), (34, "a\x1fb c\x85d"), (-3, prose(7, 50)), (40, "<|endoftext|> it's I'll 3rd"),
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """Edge cases, with further columns whose names the operators use themselves."""
    rows = [
        (i, t, ("en", "fr", None)[k % 3], ("b", "a", None, "é")[k % 4], len(t or ""), 0.5, "own")
        for k, (i, t) in enumerate(edge_texts())
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
