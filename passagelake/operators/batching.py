"""Calls of a model: inputs of similar length together, and a bad input costs itself only.

A model pads the inputs of a call to the longest of them.  A task sorts what it has by length and
packs calls up to a number of inputs and a budget of padded length, which wastes little;
results go back to their rows.  A call that fails is split in halves until the bad
inputs stand alone; these get an error instead of a result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

#: Longest error that is kept.
ERROR_LENGTH = 500


def packed(lengths: Sequence[int], most: int, budget: int | None) -> list[list[int]]:
    """Positions in calls of at most ``most`` inputs, whose count times longest stays within ``budget``.

    Longest first, so that memory runs out at once or not at all.  An input beyond the budget is a call
    of its own.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    calls: list[list[int]] = []
    for i in order:
        room = calls and len(calls[-1]) < most
        if room and (budget is None or (len(calls[-1]) + 1) * lengths[calls[-1][0]] <= budget):
            calls[-1].append(i)
        else:
            calls.append([i])
    return calls


def call_in_batches(
    inputs: Sequence, call: Callable[[list], Sequence], most: int, budget: int | None = None,
    length: Callable[[object], int] = len, split_errors: bool = False,
) -> tuple[list, list[str | None]]:
    """``(results, errors)`` of ``call`` over the inputs that aren't None, in their order.

    With ``split_errors`` an input the call fails on has a None result and its error; otherwise the
    first failure is raised.
    """
    results: list = [None] * len(inputs)
    errors: list[str | None] = [None] * len(inputs)
    wanted = [i for i, x in enumerate(inputs) if x is not None]

    def run(rows: list[int]) -> None:
        try:
            found = call([inputs[i] for i in rows])
            if len(found) != len(rows):
                raise ValueError(f"{len(found)} results for {len(rows)} inputs")
        except Exception as error:
            if not split_errors:
                raise
            if len(rows) == 1:
                errors[rows[0]] = f"{type(error).__name__}: {error}"[:ERROR_LENGTH]
                return
            half = len(rows) // 2
            run(rows[:half])
            run(rows[half:])
        else:
            for i, value in zip(rows, found):
                results[i] = value

    for rows in packed([length(inputs[i]) for i in wanted], most, budget):
        run([wanted[i] for i in rows])
    return results, errors
