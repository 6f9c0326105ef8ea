"""Repair of conversation structure by the cheapest edits, found by iterative-deepening A*.

Turns are kept (K), given another role (R), deleted (D), or one without text is inserted (I),
until the initials of the roles read ``(s?(ua)+)?``.  Keeping costs 0, another role 2 (user
or assistant), deleting 3, inserting 2 (user or assistant); a truncated turn that stays costs 1
more.  Blank and repeated turns have to go.  Of all cheapest repairs the one whose edits spell
the least string (in ASCII) is told.

* *Search.*  Depth first in the order D, I, K, R under a bound on the cost, which rises to the
  least cost that was cut off.  States (turn, place in the pattern) that failed are
  remembered with the budget they failed with.  The first path that accepts is the answer, as
  bounds only rise and edits are tried in order.
* *Estimate.*  Turns that must go, truncated ones, and roles that fit nowhere have a price
  each; between the other turns, every pair whose roles don't alternate costs an insertion, or
  shares a changed role with the pair beside it.  This never exceeds what is left to
  pay, and seldom falls far short, so that long conversations need few rounds.
* *Rows.*  Faults are told by expressions on short rows (digests instead of texts), which meet
  by conversation in the order of their turns; a task streams over them and holds one byte
  a turn.  Texts are shuffled once, to meet the edits of their conversation, and stream
  past as well: no conversation's texts are gathered, however many turns it has.

Order: by turn, null turns first; turns of one number by role, then by MD5 of the text.  Null
roles and texts are one space (the text is blank then, the role fits nowhere).  Null
conv_ids are a conversation.  Repeated rows are turns of their own, all but the first
repeated.  Without rows the result is empty.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from passagelake.llm.common import BLANKS, crc32_of, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ENDS = (".", "!", "?")
ROLES = {"u": "user", "a": "assistant"}
#: The pattern's places: nothing yet, after s, after u, after a; what comes next, and where it leads.
NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
ACCEPTING = (0, 3)
#: Codes of a turn that must go and of a role that fits nowhere; others are their role's
#: initial.  A capital is a truncated turn.
GONE, NOWHERE = "-", "x"
#: Edits of so many different conversations are remembered by a task.
REMEMBERED = 100_000


# --- one conversation, as a string of codes -------------------------------------


class Estimate:
    """Lower bounds of what is left to pay from each turn and place of the pattern."""

    def __init__(self, codes: str):
        n = len(codes)
        #: Prices of single turns from each on; the next turn that alternates, the turns
        #: between that fit nowhere, and whether one of those is truncated.
        self.single, self.next = [0] * (n + 1), [n] * (n + 1)
        self.between, self.loose = [0] * (n + 1), [False] * (n + 1)
        self.first_s = [n] * (n + 1)
        #: From a turn that alternates on: all pairs' price, and the price without its next pair.
        self.pairs, self.later = [0] * (n + 1), [0] * (n + 1)
        self.role = codes.lower() + "u"  # the end wants what a further turn of the user wants
        for i in range(n - 1, -1, -1):
            c, role = codes[i], self.role[i]
            price = DELETE if c == GONE else TRUNCATED * c.isupper() + (0 if role in "ua" else REROLE)
            self.single[i] = self.single[i + 1] + price
            self.first_s[i] = i if role == "s" else self.first_s[i + 1]
            if role in "ua":
                self.next[i], self.between[i], self.loose[i] = i, 0, False
                self.later[i] = self._pairs_from(i + 1, "a" if role == "u" else "u", True)
                self.pairs[i] = self._pairs_from(i + 1, "a" if role == "u" else "u")
            else:
                gone = c == GONE
                self.next[i] = self.next[i + 1]
                self.between[i] = self.between[i + 1] + (not gone)
                self.loose[i] = self.loose[i + 1] or (not gone and c.isupper())

    def _pairs_from(self, i: int, wanted: str, free: bool = False) -> int:
        """Price of the pairs from the turn that is wanted at ``i`` on."""
        f = self.next[i]
        if free:
            return self.pairs[f]
        if self.between[i] % 2:
            wanted = "a" if wanted == "u" else "u"
        if self.role[f] == wanted or self.loose[i]:
            return self.pairs[f]
        # An insertion, or a deleted turn of those between; or another role for f itself.
        return min((1 if self.between[i] else INSERT) + self.pairs[f], REROLE + self.later[f])

    def __call__(self, i: int, place: int) -> int:
        if place == 0:
            if self.next[i] == len(self.role) - 1 and not self.between[i]:
                return self.single[i]  # nothing is left that could stay
            s = self.first_s[i]
            if s < len(self.role) - 1:  # this one may stay as it is
                return self.single[i] - REROLE + self.pairs[self.next[s + 1]]
        if place == 1 and i == len(self.role) - 1:
            return 2 * INSERT
        return self.single[i] + self._pairs_from(i, NEXT[place][0])


def cheapest_edits(codes: str) -> tuple[int, str]:
    """The cost of the cheapest repair, and its edits."""
    estimate = Estimate(codes)
    bound, failed = estimate(0, 0), {}
    while True:
        path, above = _search(codes, estimate, bound, failed)
        if path is not None:
            return bound, path
        bound = above


def _edits(codes: str, i: int, place: int) -> list[tuple[str, int, int, int]]:
    """``(edit, cost, next turn, next place)``, the last edit in ASCII order first."""
    wanted, follows = NEXT[place]
    out = []
    if i < len(codes):
        c = codes[i]
        if c != GONE:
            role, more = c.lower(), TRUNCATED * c.isupper()
            if role == wanted:
                out.append(("K", KEEP + more, i + 1, follows))
            else:
                out.append(("R", REROLE + more, i + 1, follows))
                if role == "s" and place == 0:
                    out.append(("K", KEEP + more, i + 1, 1))
    out.append(("I", INSERT, i, follows))
    if i < len(codes):
        out.append(("D", DELETE, i + 1, place))
    return out


def _search(codes: str, estimate: Estimate, bound: int, failed: dict) -> tuple[str | None, int]:
    """The first accepting path within the bound, or None and the least cost cut off."""
    above, path = 1 << 60, []
    # Entries: a state to try with what may still be spent, or a state that has failed.
    stack = [(False, 0, 0, bound, "")]
    while stack:
        done, i, place, left, edit = stack.pop()
        if done:
            failed[i, place] = max(left, failed.get((i, place), -1))
            path.pop()
            continue
        least = estimate(i, place)
        if least > left:
            above = min(above, bound - left + least)
            continue
        if failed.get((i, place), -1) >= left:
            # What it was cut off at then lies above the bound by at least one.
            above = min(above, bound + 1)
            continue
        path.append(edit)
        if i == len(codes) and place in ACCEPTING:
            return "".join(path), bound
        stack.append((True, i, place, left, ""))
        for e, cost, j, then in _edits(codes, i, place):
            stack.append((False, j, then, left - cost, e))
    return None, above


# --- rows ------------------------------------------------------------------------


def trimmed(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(BLANKS))


def marked(turns: DataFrame) -> DataFrame:
    """``turns (conv_id, turn, role, text)`` in short: ``initial``, ``digest`` and faults told by a row alone.

    A column ``dropped``, if there is one, marks rows that only name a conversation.
    """
    dropped = F.col("dropped") if "dropped" in turns.columns else F.lit(False)
    filled = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        dropped.alias("dropped"),
    )
    return filled.select(
        "conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"), "dropped",
        F.left("role", F.lit(1)).alias("initial"), (trimmed("text") == "").alias("blank"),
        (~F.right(trimmed("text"), F.lit(1)).isin(*ENDS)).alias("truncated"), "text",
    )


AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
ORDER = ("conv_id", "turn", "role", "digest")


class _Conversation:
    """What a task holds of the conversation that streams past."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes = conv_id, []
        self.low = self.high = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated and not (blank or duplicate)
        code = initial if initial in ("s", "u", "a") else NOWHERE
        self.codes.append(GONE if blank or duplicate else code.upper() if truncated else code)

    def row(self, remembered: dict) -> tuple:
        codes = "".join(self.codes)
        found = remembered.get(codes)
        if found is None:
            found = cheapest_edits(codes)
            if len(remembered) < REMEMBERED and len(codes) <= 64:
                remembered[codes] = found
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *found)


def _table(rows: list[tuple], layout: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in layout.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def _audits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, remembered, out = None, {}, []
    for batch in batches:
        for conv_id, turn, initial, dropped, blank, duplicate, truncated in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    out.append(current.row(remembered))
                current = _Conversation(conv_id)
            if not dropped:
                current.add(turn, initial, blank, duplicate, truncated)
        if out:
            yield _table(out, AUDIT)
            out = []
    if current is not None:
        yield _table([current.row(remembered)], AUDIT)


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation of ``turns`` its faults, the cost of the cheapest repair and its edits."""
    short = marked(turns).drop("text").repartition("conv_id")
    # How often a turn was said before is a running count, which streams.
    said = Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy("turn")
    rows = short.withColumn("duplicate", F.row_number().over(said) > 1).sortWithinPartitions(*ORDER, "duplicate")
    return rows.select("conv_id", "turn", "initial", "dropped", "blank", "duplicate", "truncated").mapInArrow(_audits, AUDIT)


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv_id, place, edit, role, text)`` of a sorted stream of edits and turns.

    A conversation's edits come first; an entry of edit None opens each conversation.
    """
    conv_id, edits, at, place, follows = None, "", 0, 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, place, follows
        while at < len(edits) and edits[at] == "I":
            role, follows = NEXT[follows]
            yield conv_id, place, "I", ROLES[role], ""
            at, place = at + 1, place + 1

    for batch in batches:
        for conv, audit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if audit is not None:
                conv_id, edits, at, place, follows = conv, audit, 0, 0, 0
                yield conv_id, -1, None, None, None
                yield from inserted()
                continue
            edit, at = edits[at], at + 1
            if edit != "D":
                wanted, then = NEXT[follows]
                if edit == "K" and follows == 0 and role[:1] == "s":
                    then = 1
                yield conv_id, place, edit, ROLES[wanted] if edit == "R" else role, text
                follows, place = then, place + 1
            yield from inserted()


def _with_edits(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits and turns of each conversation together and in order."""
    rows = marked(turns).where(~F.col("dropped")).select(
        "conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "role", "digest", "text"
    )
    nothing = F.lit(None).cast("string")
    first = edits.select(
        "conv_id", F.lit(0).alias("kind"), "audit", F.lit(None).cast("long").alias("turn"), nothing.alias("role"),
        nothing.alias("digest"), nothing.alias("text"),
    )
    both = first.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:])
    return both.select("conv_id", "audit", "role", "text")


REPAIRED = "conv_id long, place long, edit string, role string, text string"
DIGEST = "conv_id long, repaired_sha256 string"


def repaired_turns(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """The turns that stay or are inserted: ``(conv_id, place, edit, role, text)``."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in _repaired(batches):
            if row[2] is not None:
                out.append(row)
                size += len(row[4])
            if len(out) >= 10_000 or size > 1 << 23:
                yield _table(out, REPAIRED)
                out, size = [], 0
        yield _table(out, REPAIRED)

    return _with_edits(turns, edits).mapInArrow(tell, REPAIRED)


def repaired_digests(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation: its ``role:text`` joined by newlines."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, digest = [], None, None
        for conv_id, place, edit, role, text in _repaired(batches):
            if edit is None:
                if digest is not None:
                    out.append((last, digest.hexdigest()))
                last, digest = conv_id, hashlib.sha256()
                if len(out) >= 10_000:
                    yield _table(out, DIGEST)
                    out = []
                continue
            digest.update(("\n" if place else "").encode() + f"{role}:{text}".encode())
        if digest is not None:
            out.append((last, digest.hexdigest()))
        yield _table(out, DIGEST)

    return _with_edits(turns, edits).mapInArrow(tell, DIGEST)


def repair(turns: DataFrame) -> DataFrame:
    """Faults, cost, edits and the digest of the repaired text per conversation."""
    edits = stored(audits(turns), "edits")
    found = repaired_digests(turns, edits)
    same = edits["conv_id"].eqNullSafe(found["conv_id"])
    return edits.join(found, same).select(edits["*"], found["repaired_sha256"])


def damaged(turns: DataFrame, period: int = 20) -> DataFrame:
    """``turns`` with faults, by the remainder of a checksum of ``conv_id:turn`` (nulls: one space).

    0 marks the row as ``dropped``, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4
    makes it the user's.
    """
    written = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    filled = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.concat_ws(":", *written).alias("key"),
    ).withColumn("kind", crc32_of("key") % period)
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat((kind == 0), F.when(kind == 3, 2).otherwise(1)))
    return filled.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        copies.alias("dropped"),
    )
