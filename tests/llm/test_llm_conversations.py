"""Conversation repair against dynamic programming and a plain reading of the rules."""

import hashlib
import random
import zlib

import pytest

from conftest import rows_of
from passagelake.llm import conversation_repair as repairs
from passagelake.llm.queries import LLM_QUERIES

COLUMNS = (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
)
SCHEMA = "conv_id long, turn long, role string, text string, digest string, blank string, place long"


def cheapest(codes):
    """Forward over turns: per place of the pattern the least (cost, edits)."""
    leads = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}

    def offer(best, place, value):
        if place not in best or value < best[place]:
            best[place] = value

    def insert(best):
        for _ in range(2):
            for place, (cost, edits) in list(best.items()):
                offer(best, leads[place][1], (cost + 2, edits + "I"))
        return best

    best = insert({0: (0, "")})
    for code in codes:
        after = {}
        for place, (cost, edits) in best.items():
            offer(after, place, (cost + 3, edits + "D"))
            if code != "-":
                role, more = code.lower(), int(code.isupper())
                wanted, then = leads[place]
                offer(after, then, (cost + 2 + more, edits + "R"))
                if role == wanted:
                    offer(after, then, (cost + more, edits + "K"))
                if role == "s" and place == 0:
                    offer(after, 1, (cost + more, edits + "K"))
        best = insert(after)
    return min(best[p] for p in (0, 3) if p in best)


def test_search_is_exact_and_told_in_ascii_order():
    chooser = random.Random(1)
    for _ in range(6000):
        letters = chooser.choice(["uaUA-xsXS", "ua", "uuaaUA", "uas-", "uaS", "xX"])
        codes = "".join(chooser.choice(letters) for _ in range(chooser.randrange(14)))
        assert repairs.cheapest_edits(codes) == cheapest(codes), codes


def test_estimate_never_exceeds_what_is_left():
    chooser = random.Random(2)
    for _ in range(3000):
        codes = "".join(chooser.choice("uaUA-xsXS") for _ in range(chooser.randrange(10)))
        estimate = repairs.Estimate(codes)
        for i in range(len(codes) + 1):
            assert estimate(i, 0) <= cheapest(codes[i:])[0], (codes, i)


@pytest.mark.parametrize("letters", ["ua", "uaUAxXsS-", "uuuaa-", "x", "s"])
def test_long_conversations(letters):
    chooser = random.Random(3)
    codes = "".join(chooser.choice(letters) for _ in range(2500))
    assert repairs.cheapest_edits(codes) == cheapest(codes)


BLANKS = " \t\n\x0b\x0c\r"


def expected(rows, damage=True):
    """All columns per conversation, from (conv_id, turn, role, text)."""
    kept = {}
    for conv, turn, role, text in rows:
        mine = kept.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * ((kind != 0) + (kind == 3))
    out = []
    for conv, mine in kept.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, codes, counts = set(), "", [0, 0, 0]
        for _, role, text in mine:
            body = text.strip(BLANKS)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in (0, 1) else code.upper() if fault == 2 else code
        initials = [r[1][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {r[0] for r in mine} - {None}
        cost, edits = cheapest(codes)
        lines, place, at = [], 0, iter(mine)
        for e in edits:
            _, role, text = (None, "", "") if e == "I" else next(at)
            if e == "D":
                continue
            wanted, then = repairs.NEXT[place]
            if e == "K" and place == 0 and role[0] == "s":
                then = 1
            lines.append(f"{role if e == 'K' else {'u': 'user', 'a': 'assistant'}[wanted]}:{text}")
            place = then
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, edits, digest))
    return sorted(out, key=repr)


def edge_rows():
    chooser = random.Random(5)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(chooser.randrange(1, 12)):
            role = chooser.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Ünder"])
            text = chooser.choice(["Yes.", "No", "", None, " \n", "Why?\n ", "é!", "long " * 50 + ".", "a\x1fb.", "x. . ."])
            rows.append((conv, chooser.choice([turn, turn * 2, None, turn]), role, text))
    rows += [(1000, 2, "user", "Hello."), (1000, 2, "user", "Hello."), (1000, 2, "user", "Hello!"), (1001, None, "user", "x")]
    rows += [(2000, t, ("user", "assistant")[t % 2], f"Turn {t % 700}.") for t in range(3000)]  # one long conversation
    rows += [(2001, 5, "user", "Same.")] * 2500  # and one of copies
    rows += [(c, t, "user", "Dropped.") for c in range(3000, 3040) for t in range(1)]  # some lose all they have
    return rows


@pytest.mark.parametrize("damage", [True, False])
def test_repair_against_the_rules(spark, damage):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "own", "own", 1) for r in rows], SCHEMA).repartition(7)
    found = repairs.repair(repairs.damaged(df) if damage else df)
    assert tuple(found.columns) == COLUMNS
    got = rows_of(found, *COLUMNS)
    assert got == expected(rows, damage)
    if damage:
        empty = [r for r in got if r[7] == ""]
        assert empty and all(r[1:8] == (0, 0, 0, 0, 0, 0, "") and r[8] == hashlib.sha256(b"").hexdigest() for r in empty if r[0])


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repairs.repair(repairs.damaged(df)).count() == 0
    assert repairs.repaired_turns(df, repairs.audits(df)).count() == 0


def test_repaired_turns_follow_the_pattern(spark):
    df = spark.createDataFrame([(*r, "own", "own", 1) for r in edge_rows()], SCHEMA)
    broken = repairs.damaged(df)
    rows = repairs.repaired_turns(broken, repairs.audits(broken)).collect()
    chats = {}
    for r in sorted(rows, key=lambda r: r.place):
        chats.setdefault(r.conv_id, []).append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in repairs.repair(broken).collect()}
    for conv, turns in chats.items():
        initials = "".join(r.role[0] for r in turns).removeprefix("s")
        assert initials == "ua" * (len(initials) // 2) and [r.place for r in turns] == list(range(len(turns)))
        text = "\n".join(f"{r.role}:{r.text}" for r in turns)
        assert digests[conv] == hashlib.sha256(text.encode()).hexdigest()


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(LLM_QUERIES["op11_conversation_repair"](spark, folder), *COLUMNS) == expected(rows)
