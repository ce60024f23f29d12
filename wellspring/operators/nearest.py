"""Running exact top-k of squared L2 distance, one numpy state per Spark partition."""

import numpy as np

ROW_BLOCK = 4096
QUESTION_BLOCK = 512
PAIR_BLOCK = 256
# Groups of rows whose nearest ones bound the k-th distance of a block.
GROUPS = 128
GRID = 1e9
# Squared norms up to here leave single precision room for sums and products.
SINGLE_RANGE = 1e36


class RunningTopK:
    """Keeps the k best (distance, id) per question while blocks of rows pass by.

    A matrix product only selects candidates, with a margin that covers its worst-case
    rounding error; candidates are measured again in double and ranked on (distance settled
    to nine decimals, id), so results do not depend on partitioning. Where copies or near
    copies crowd the candidates, copies are dropped and the product is taken in double;
    so it is where norms leave the range of single precision. Questions that hold NaN or
    infinity are near nothing.
    """

    def __init__(self, questions: np.ndarray, k: int):
        self.k = k
        self.questions = np.ascontiguousarray(questions, dtype=np.float32)
        self.norms = _norms(self.questions)
        self.distance = np.full((len(questions), k), np.inf)
        self.ids = np.full((len(questions), k), np.iinfo(np.int64).max)

    def fold(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Take in a block of rows. Rows that hold NaN or infinity are near nothing."""
        sound = np.isfinite(rows).all(axis=1)
        if not sound.all():
            ids, rows = ids[sound], rows[sound]
        for start in range(0, len(rows), ROW_BLOCK):
            block = rows[start : start + ROW_BLOCK]
            block_ids = ids[start : start + ROW_BLOCK]
            norms = _norms(block)
            for first in range(0, len(self.questions), QUESTION_BLOCK):
                self._fold_block(slice(first, first + QUESTION_BLOCK), block_ids, block, norms)

    def fold_for(self, only: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``fold`` for the questions of the given numbers alone."""
        part = RunningTopK(self.questions[only], self.k)
        part.distance, part.ids = self.distance[only], self.ids[only]
        part.fold(ids, rows)
        self.distance[only], self.ids[only] = part.distance, part.ids

    def _fold_block(self, span: slice, ids: np.ndarray, rows: np.ndarray, norms: np.ndarray) -> None:
        largest = max(norms.max(initial=0), self.norms[span].max(initial=0))
        which, row = self._candidates(span, rows, norms, np.float32 if largest < SINGLE_RANGE else np.float64)
        if len(row) > 4 * self.k * len(self.questions[span]):
            kept = first_copies(ids, rows, self.k)
            ids, rows, norms = ids[kept], rows[kept], norms[kept]
            which, row = self._candidates(span, rows, norms, np.float64)
        if len(row):
            self._merge(span, which, measure(self.questions[span], rows, which, row), ids[row])

    def _candidates(self, span: slice, rows: np.ndarray, norms: np.ndarray, kind: type):
        """Question and row numbers of all pairs that may be among the k best. ``kind`` is
        the precision of the product: single is fast, double leaves few near-ties.

        A pair's squared distance is the question's squared norm less twice its ``rough``, so what
        is compared is the product, less half the row's squared norm, with a floor per question."""
        error = (rows.shape[1] + 8) * np.finfo(kind).eps / 2
        margin = error * (norms.max() + self.norms[span]) + 2 / GRID
        rough = self.questions[span].astype(kind, copy=False) @ rows.astype(kind, copy=False).T
        rough -= (norms / 2).astype(kind)
        floor = (self.norms[span] - self.distance[span, -1] - margin) / 2
        near = rough >= below(floor, kind)[:, None]
        if np.count_nonzero(near) > 4 * self.k * len(rough) and len(rows) > self.k:
            near = rough >= below(np.maximum(floor, kth_largest(rough, self.k) - margin), kind)[:, None]
        return marked(near)

    def _merge(self, span: slice, which, distance, ids) -> None:
        known = np.isfinite(self.distance[span])
        which = np.concatenate([which, np.nonzero(known)[0]])
        distance = np.concatenate([distance, self.distance[span][known]])
        ids = np.concatenate([ids, self.ids[span][known]])
        order = np.lexsort((ids, distance, which))
        which, distance, ids = which[order], distance[order], ids[order]
        rank = np.arange(len(which)) - np.searchsorted(which, which)
        best = rank < self.k
        self.distance[span][which[best], rank[best]] = distance[best]
        self.ids[span][which[best], rank[best]] = ids[best]

    def hits(self):
        """Question numbers, ids and distances of all kept rows."""
        number, place = np.nonzero(np.isfinite(self.distance))
        return number, self.ids[number, place], self.distance[number, place]


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows, dtype=np.float64)


def below(limit: np.ndarray, kind: type) -> np.ndarray:
    """``limit`` in another precision, never above what it was."""
    with np.errstate(over="ignore"):
        return np.nextafter(limit.astype(kind), kind(-np.inf))


def kth_largest(rough: np.ndarray, k: int) -> np.ndarray:
    """A lower bound of the k-th largest number of each line: the k-th largest of the tops of GROUPS
    groups, as so many numbers are no smaller, or that number itself on a short line. Neighbours, which
    may be alike, are in different groups."""
    size = rough.shape[1] // GROUPS
    tops = rough
    if size > 1 and k <= GROUPS:
        tops = rough[:, : GROUPS * size].reshape(len(rough), size, GROUPS).max(axis=1)
    return np.partition(tops, tops.shape[1] - k, axis=1)[:, tops.shape[1] - k].astype(np.float64)


def marked(near: np.ndarray):
    """``np.nonzero`` of a table in which few cells are set: unset ones are passed eight at a time."""
    cells = near.reshape(-1)
    whole = len(cells) // 8 * 8
    eights = np.flatnonzero(cells[:whole].view(np.uint64))
    at = (eights[:, None] * 8 + np.arange(8)).reshape(-1)
    at = np.concatenate([at[cells[at]], whole + np.flatnonzero(cells[whole:])])
    return np.divmod(at, near.shape[1])


def measure(questions, rows, which, row) -> np.ndarray:
    out = np.empty(len(row))
    for start in range(0, len(row), PAIR_BLOCK):
        part = slice(start, start + PAIR_BLOCK)
        gap = rows[row[part]].astype(np.float64) - questions[which[part]]
        out[part] = (gap * gap).sum(axis=1)
    return np.floor(out * GRID + 0.5) / GRID


def first_copies(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Row numbers without those having k equal rows of lower id: such a row can never be
    among the k best. Keeps a heavy group of copies from being measured again and again."""
    words = np.ascontiguousarray(rows).view(np.uint32).astype(np.uint64)
    odd = np.arange(words.shape[1], dtype=np.uint64) * 2 + 1
    order = np.lexsort((ids, words @ odd**5))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (words[order[1:]] == words[order[:-1]]).all(axis=1)
    starts = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    return np.sort(order[np.arange(len(order)) - starts < k])
