"""Folds over long arrays whose cost grows with their length, not with its square.

Appending to an array copies it, so a fold that collects what it keeps works in blocks: what a
block keeps is joined, and only blocks are appended to the whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def kept_strings(
    items: Column, start: Column, step: Callable[[Column, Column], Column], rest: Callable[[Column], Column] | None = None
) -> Column:
    """Array of arrays of the strings that a fold over ``items`` keeps, in order.

    ``step`` takes the state and an item and returns a struct of the next ``state`` and what is to
    ``keep`` (null: nothing).  ``rest`` makes a last string of the final state.
    """
    none = F.array().cast("array<string>")

    def one(acc: Column, item: Column) -> Column:
        return let(step(acc["state"], item), lambda s: F.struct(
            s["state"].alias("state"),
            F.when(s["keep"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(s["keep"]))).alias("out"),
        ))

    def block(acc: Column, part: Column) -> Column:
        inside = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return let(inside, lambda r: F.struct(
            r["state"].alias("state"),
            F.when(F.size(r["out"]) == 0, acc["outs"]).otherwise(F.concat(acc["outs"], F.array(r["out"]))).alias("outs"),
        ))

    def whole(xs: Column) -> Column:
        count = F.ceil(F.size(xs) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.slice(xs, i * BLOCK + 1, BLOCK))
        first = F.struct(start.alias("state"), F.array().cast("array<array<string>>").alias("outs"))
        if rest is None:
            return F.aggregate(blocks, first, block, lambda acc: acc["outs"])
        return F.aggregate(
            blocks, first, block, lambda acc: F.concat(acc["outs"], F.array(F.array_compact(F.array(rest(acc["state"])))))
        )

    return let(items, whole)
