"""A bidirectional FM-index over delimited words, searched for many words at once in numpy."""

from __future__ import annotations

import numpy as np

# Letters have the numbers 1 to 90, the delimiter 0.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_SIGMA = len(LETTERS) + 1
_NUMBER = np.zeros(0x100, dtype=np.int64)
_NUMBER[LETTERS] = np.arange(1, _SIGMA)
LEFT, RIGHT = 0, 1


def numbers(text: str) -> np.ndarray:
    return _NUMBER[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of the rotations of a text, by doubling the length they are sorted by until all differ."""
    size, length = len(text), 1
    rank = np.unique(text, return_inverse=True)[1]
    while True:
        key = rank * size + np.roll(rank, -length)
        order = np.argsort(key, kind="stable")
        rank = np.empty(size, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        length *= 2
        if rank[order[-1]] == size - 1 or length >= size:
            return order


class BidirectionalIndex:
    """Intervals of suffix ranks for patterns that grow on either side.

    An interval is its first rank in the text, its first rank in the reversed text, and its size, which both have in
    common. ``below[side][i, c]`` counts the letters below c among the first i of that side's Burrows-Wheeler transform.
    """

    def __init__(self, words: list[str]):
        """Of distinct words."""
        text = numbers(" " + " ".join(words) + " ")[:-1]  # a rotation goes on at the beginning; spaces have number 0
        self.starts = np.flatnonzero(text == 0)
        self.ranks = suffix_array(text)
        self.below = [self._below(text, self.ranks), self._below(text[::-1], suffix_array(text[::-1]))]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=_SIGMA))))
        self.size = len(text)

    @staticmethod
    def _below(text: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        before = text[ranks - 1]
        found = np.zeros((len(text) + 1, _SIGMA + 1), dtype=np.int32)
        found[np.arange(1, len(text) + 1), before + 1] = 1
        np.cumsum(found, axis=0, out=found)
        return np.cumsum(found, axis=1, out=found)

    def extended(self, side: int, at: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The intervals ``at``, one a row, with a letter more on one side."""
        below, own, other, size = self.below[side], at[:, side], at[:, 1 - side], at[:, 2]
        low, high = below[own, letters], below[own + size, letters]
        low_next, high_next = below[own, letters + 1], below[own + size, letters + 1]
        found = np.empty_like(at)
        found[:, side] = self.first[letters] + low_next - low
        found[:, 1 - side] = other + high - low
        found[:, 2] = high_next - high - low_next + low
        return found

    def branches(self, side: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All letters that follow: rows of ``at``, letters and the intervals; not the delimiter."""
        below, own, size = self.below[side], at[:, side], at[:, 2]
        counts = np.diff(below[own + size] - below[own], axis=1)
        counts[:, 0] = 0
        rows, letters = np.nonzero(counts)
        return rows, letters, self.extended(side, at[rows], letters)

    def near(self, query: np.ndarray, half: int, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``query`` and the numbers of the words that are one error away from them.

        The queries have one length. Going to the RIGHT, their first ``half`` letters and the beginning of a word match
        exactly, and the one error is behind; going to the LEFT, the others and the end of a word, and it is before. An
        error is a letter replaced, left out, or put in before any of the rest or the delimiter.
        """
        count, length = query.shape
        exact_part, rest = (query[:, :half], query[:, half:]) if side == RIGHT else (query[:, half:], query[:, :half][:, ::-1])
        back = exact_part[:, ::-1] if side == RIGHT else exact_part
        exact = np.broadcast_to(np.array([0, 0, self.size]), (count, 3))
        for letters in [*back.T, np.zeros(count, dtype=np.int64)]:
            exact = self.extended(1 - side, exact, letters)
        rows = np.flatnonzero(exact[:, 2])
        exact = exact[rows]
        wrong, wrong_rows = np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64)
        for k in range(rest.shape[1] + 1):
            of, letters, branched = self.branches(side, exact)
            # One letter put in.
            wrong, wrong_rows = np.concatenate([wrong, branched]), np.concatenate([wrong_rows, rows[of]])
            if k == rest.shape[1]:
                break
            wrong = self.extended(side, wrong, rest[wrong_rows, k])
            replaced = letters != rest[rows[of], k]
            wrong = np.concatenate([wrong, branched[replaced], exact])  # and one left out
            wrong_rows = np.concatenate([wrong_rows, rows[of[replaced]], rows])
            exact = self.extended(side, exact, rest[rows, k])
            wrong, wrong_rows = wrong[wrong[:, 2] > 0], wrong_rows[wrong[:, 2] > 0]
            rows, exact = rows[exact[:, 2] > 0], exact[exact[:, 2] > 0]
        wrong = self.extended(side, wrong, np.zeros(len(wrong), dtype=np.int64))
        found = wrong[:, 2] > 0
        return wrong_rows[found], np.searchsorted(self.starts, self.ranks[wrong[found, LEFT]])
