"""Quality by a convolutional network over bytes, trained in numpy.

The network sees every byte and whether its word repeats the one before. Learned filters slide over the whole text in
steps of half their width; the largest response of each is kept within overlapping chunks. A filter's largest and mean
value over the chunks are combined into one probability. Texts are read from the first to the last byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from sluicebox.llm.classify import best_threshold, fitted, labelled_sample, odds, probabilities, with_scores
from sluicebox.llm.hashing import Words, batches

# A filter reads two steps of STEP bytes, and a chunk two blocks of BLOCK bytes.
STEP = 4
BLOCK = 64
DIMENSIONS = 6
FILTERS = 8
# A byte, a byte of a repeated word, and what fills up the last block.
SYMBOLS = 513
FILL = 512
# The model is fitted on at most so many labelled rows, those whose ids hash lowest; longer texts than this are learned
# from in slices spread over the whole text. A sixth of them is kept for calibration.
SAMPLE_ROWS = 9_000
SAMPLE_CHARS = 20_000
STEPS = 1_000
BATCH = 16
RATE = 0.01
# The score from which a text counts as good.
THRESHOLD = 0.7


def symbols(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of some texts, each filled up to whole blocks, and the number of blocks of each."""
    words = Words(group)
    hashes = words.hashes()
    repeated = np.zeros(len(hashes), dtype=bool)
    repeated[1:] = hashes[1:] == hashes[:-1]
    repeated[words.first[:-1][words.first[:-1] < len(hashes)]] = False
    change = np.zeros(len(words.raw) + 1, dtype=np.int16)
    change[words.start[repeated]] += 1
    change[words.end[repeated]] -= 1
    flags = np.cumsum(change[:-1]) * 256
    lengths = np.array([len(raw) for raw in group])
    blocks = lengths // BLOCK + 1  # with at least one byte of fill
    found = np.full(blocks.sum() * BLOCK, FILL, dtype=np.int32)
    begins = np.concatenate(([0], np.cumsum(blocks * BLOCK)[:-1]))
    sources = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    raw = np.frombuffer(b"".join(group), dtype=np.uint8)
    places = np.arange(len(raw)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    found[np.repeat(begins, lengths) + places] = raw + flags[np.repeat(sources, lengths) + places]
    return found, blocks


@dataclass
class ByteCnn:
    table: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float = 0.0
    moments: dict = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int) -> ByteCnn:
        draw = np.random.default_rng(seed)
        table = draw.normal(0, 0.5, (SYMBOLS, DIMENSIONS)).astype(np.float32)
        table[FILL] = 0
        size = STEP * DIMENSIONS
        near, far = draw.normal(0, 1 / np.sqrt(size), (2, size, FILTERS)).astype(np.float32)
        return cls(table, near, far, np.zeros(FILTERS, np.float32), draw.normal(0, 0.2, 2 * FILTERS).astype(np.float32))

    def _forward(self, found: np.ndarray, blocks: np.ndarray) -> tuple:
        """Pooled values of each text, and what training needs."""
        per_block = BLOCK // STEP
        steps = self.table[found].reshape(-1, STEP * DIMENSIONS)
        responses = steps @ self.near + self.bias
        following = steps @ self.far
        last = np.cumsum(blocks) * per_block - 1  # of a text; the next step is another text's
        following[last[:-1] + 1] = 0
        responses[:-1] += following[1:]
        following = None
        by_block = responses.reshape(-1, per_block, FILTERS)
        tops = np.maximum(by_block.max(axis=1), 0)
        ends = np.cumsum(blocks)
        begins = ends - blocks
        after = np.arange(1, len(tops) + 1)
        after[ends - 1] -= 1  # a text's last chunk is its last block
        chunks = np.maximum(tops, tops[after])
        largest = np.maximum.reduceat(tops, begins, axis=0)
        mean = np.add.reduceat(chunks, begins, axis=0) / blocks[:, None]
        return np.concatenate([largest, mean], axis=1), steps, by_block, tops, after, begins

    def logits(self, found: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        return self._forward(found, blocks)[0] @ self.out + self.out_bias

    def _update(self, name: str, value: np.ndarray, gradient: np.ndarray, rate: float) -> None:
        if name not in self.moments:
            self.moments[name] = [np.zeros_like(value), np.zeros_like(value)]
        mean, square = self.moments[name]
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient**2 - square)
        value -= rate * mean / (np.sqrt(square) + 1e-7)

    def train(self, found: np.ndarray, blocks: np.ndarray, labels: np.ndarray, rate: float) -> None:
        pooled, steps, by_block, tops, after, begins = self._forward(found, blocks)
        per_block = BLOCK // STEP
        wrong = ((probabilities(pooled @ self.out + self.out_bias) - labels) / len(labels)).astype(np.float32)
        back_top = np.zeros_like(tops)
        # The largest value of a text comes from one of its blocks.
        for i, (a, n) in enumerate(zip(begins.tolist(), blocks.tolist(), strict=True)):
            back_top[a + tops[a : a + n].argmax(axis=0), np.arange(FILTERS)] += wrong[i] * self.out[:FILTERS]
        # The mean of a text comes from the larger block of every chunk.
        of_chunk = np.repeat(wrong / blocks, blocks)[:, None] * self.out[FILTERS:]
        own = tops >= tops[after]
        back_top += of_chunk * own
        np.add.at(back_top, after, of_chunk * ~own)
        back_top *= tops > 0
        back = np.zeros_like(by_block)
        np.put_along_axis(back, by_block.argmax(axis=1)[:, None, :], back_top[:, None, :], axis=1)
        back = back.reshape(-1, FILTERS)
        back_far = np.concatenate([np.zeros((1, FILTERS), np.float32), back[:-1]])
        last = np.cumsum(blocks) * per_block - 1
        back_far[last[:-1] + 1] = 0
        back_steps = (back @ self.near.T + back_far @ self.far.T).reshape(-1, DIMENSIONS)
        change = np.stack([np.bincount(found, back_steps[:, k], SYMBOLS) for k in range(DIMENSIONS)], axis=1).astype(np.float32)
        change[FILL] = 0
        near, far = steps.T @ back, steps.T @ back_far
        self._update("near", self.near, near, rate)
        self._update("far", self.far, far, rate)
        self._update("bias", self.bias, back.sum(axis=0), rate)
        self._update("table", self.table, change, rate)
        self._update("out", self.out, wrong @ pooled, rate)
        self.out_bias -= rate * float(wrong.sum())


def texts_symbols(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, group in batches(texts):
        yield symbols(group)


@dataclass
class QualityModel:
    network: ByteCnn
    shift: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found = [self.network.logits(*some) for some in texts_symbols(texts)]
        return probabilities((np.concatenate(found) if found else np.zeros(0)) + self.shift)


def fit(texts: list[str | None], labels: list[int], seed: int = 11) -> QualityModel:
    """A model of some labelled texts. The last sixth of them calibrates the score."""
    network = ByteCnn.new(seed)
    model = QualityModel(network, 0.0)
    y = np.array(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        network.out[:] = 0
        model.shift = -4.0 if len(y) and not y[0] else 4.0
        return model
    held = max(1, len(y) // 6)
    order, draw = np.arange(len(y) - held), np.random.default_rng(seed)
    each = [symbols([(texts[i] or "").encode("utf-8", "surrogatepass")])[0].astype(np.int16) for i in order.tolist()]
    network.out_bias = odds(min(max(y[: len(order)].mean(), 0.01), 0.99))
    at = len(order)
    for step in range(STEPS):
        if at >= len(order):
            draw.shuffle(order)
            at = 0
        some, at = order[at : at + BATCH], at + BATCH
        found = [each[i] for i in some.tolist()]
        blocks = np.array([len(x) // BLOCK for x in found])
        network.train(np.concatenate(found).astype(np.int32), blocks, y[some], RATE * 0.1 ** (step / STEPS))
    network.moments = {}
    # The best split of the calibration rows becomes the threshold.
    model.shift = odds(THRESHOLD) - odds(1 - best_threshold(1 - model.scores(texts[len(order) :]), 1 - y[len(order) :], 0.5))
    return model


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """Fit on a bounded sample of the labelled rows that may be learned from, see ``labelled_sample``.

    Without such rows all texts get the same score: about 0.98, which is good.
    """
    found = labelled_sample(docs, labels, label_col, SAMPLE_ROWS, SAMPLE_CHARS, id_col, text_col)
    return fitted(found, lambda texts, labels, _: fit(texts, labels))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The input with ``score``, the probability of good quality; a column of that name is replaced.

    NULL and empty texts have the score of one block of fill.
    """
    return with_scores(docs, model, text_col)
