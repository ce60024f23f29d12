"""Cutting-stock by column generation, on a histogram of piece lengths.

A pattern says how many pieces of each length class share one sequence. The linear program
that covers the demand of every class with the fewest sequences is solved by the revised
simplex method over patterns made when needed: a knapsack dynamic program finds the pattern of
largest worth at the current dual prices. It ends when no pattern is worth more than a
sequence, or when the bound from the best worth proves the rest to be within ``gap``. The
solution is rounded down, and what is left, at most a few pieces for each class, is placed
first-fit by falling length. The work depends on the number of classes alone, not on the
number of pieces.
"""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Pattern:
    """``classes`` and how often each occurs; ``copies`` sequences are filled like this."""

    classes: tuple[int, ...]
    times: tuple[int, ...]
    copies: int


def best_pattern(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the worth and the counts of the dearest filling of ``room``."""
    price = np.full(room + 1, -np.inf)
    price[sizes] = prices
    price[0] = 0.0  # a place left empty
    worth, chosen = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for space in range(1, room + 1):
        reached = price[: space + 1] + worth[space::-1]
        reached[0] = worth[space - 1]
        at = reached.argmax()
        worth[space], chosen[space] = reached[at], at
    counts, space = np.zeros(room + 1), room
    while space > 0:
        counts[chosen[space]] += 1
        space -= max(1, chosen[space])
    return float(worth[room]), counts[sizes]


def relaxed(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, amounts) of the linear program, within ``gap`` of its optimum."""
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / (room // sizes))
    amounts = inverse @ demand
    for step in range(40 * m + 200):
        prices = np.maximum(inverse.sum(axis=0), 0)
        worth, column = best_pattern(sizes, prices, room)
        if worth <= 1 + 1e-7 or amounts.sum() <= (1 + gap) * (prices @ demand) / worth:
            break
        change = inverse @ column
        up = change > 1e-9
        ratio = np.where(up, amounts / np.where(up, change, 1), np.inf)
        out = int(np.argmin(ratio))
        amounts = np.maximum(amounts - ratio[out] * change, 0)
        amounts[out] = ratio[out]
        basis[:, out] = column
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    return basis, amounts


def plan(histogram: dict[int, int], room: int, gap: float = 0.004) -> list[Pattern]:
    """Patterns whose copies hold exactly the pieces of ``histogram`` (size to number)."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n), np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[int(s)] for s in sizes], np.int64)
    patterns = []
    basis, amounts = relaxed(sizes, left.astype(float), room, gap)
    for k in np.argsort(-amounts, kind="stable"):
        times = basis[:, k].astype(np.int64)
        used = times > 0
        copies = int(min(np.floor(amounts[k] + 1e-6), (left[used] // times[used]).min()))
        if copies:
            patterns.append(Pattern(tuple(sizes[used].tolist()), tuple(times[used].tolist()), copies))
            left[used] -= copies * times[used]
    while left.any():
        space, chosen = room, {}
        for i in range(len(sizes) - 1, -1, -1):
            if take := int(min(left[i], space // sizes[i])):
                chosen[int(sizes[i])] = take
                space -= take * int(sizes[i])
        at = [int(np.searchsorted(sizes, s)) for s in chosen]
        times = np.array(list(chosen.values()))
        copies = int((left[at] // times).min())
        left[at] -= copies * times
        patterns.append(Pattern(tuple(chosen), tuple(times.tolist()), copies))
    return patterns
