"""Hashes of all words of many texts at once, in numpy.

A word's hash is a polynomial of its bytes modulo 2**64. Prefix sums over the bytes of all texts give it for every word
without a loop: the difference of two sums, divided by the power the word starts at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
# Texts hashed together hold about so many bytes; a longer text is hashed alone.
BATCH_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# What separates words of letters and digits; all bytes from 128 belong to words.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_powers = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """Powers 0 .. size - 1 of an odd number; tables are kept and doubled."""
    table = _powers.get(base)
    if table is None or len(table) < size:
        length = max(1 << 16, 1 << (size - 1).bit_length())
        table = np.full(length, base, dtype=np.uint64)
        table[0] = 1
        table = _powers[base] = np.multiply.accumulate(table)
    return table[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batches(texts: list[str | None], most: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as UTF-8 in groups of about ``most`` bytes, each with the index of its first text."""
    first, group, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if group and size + len(raw) > most:
            yield first, group
            first, group, size = i, [], 0
        group.append(raw)
        size += len(raw)
    if group:
        yield first, group


class Words:
    """The words of some texts: runs of bytes other than space, tab and line ends, with A-Z in lower case.

    With ``space``, runs of bytes that this table doesn't mark; a space has to be marked.

    ``raw`` holds the lower-cased bytes of all texts, ``start`` and ``end`` the words' places in it, and the words of text
    ``i`` are those from ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, group: list[bytes], space: np.ndarray = _SPACE):
        raw = np.frombuffer(b" ".join([*group, b""]) or b" ", dtype=np.uint8)
        self.raw = _LOWER[raw]
        gaps = np.concatenate(([True], space[raw], [True]))
        edges = np.flatnonzero(gaps[1:] != gaps[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        begins = np.cumsum([0, *(len(x) + 1 for x in group)])
        self.first = np.searchsorted(self.start, begins)
        self._sums = None

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """A hash of each word, or of its first ``prefix`` bytes and whether it is longer."""
        if self._sums is None:
            size = len(self.raw)
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, size), out=sums[1:])
            self._sums = sums
        end = self.end if prefix is None else np.minimum(self.end, self.start + prefix)
        found = (self._sums[end] - self._sums[self.start]) * _power_table(_BASE_INVERSE, len(self.raw) + 1)[self.start]
        return mixed(found + (end - self.start).astype(np.uint64) + ((end < self.end).astype(np.uint64) << np.uint64(32)))
