"""Toxicity by a convolutional network over words, trained in numpy.

A word's vector is the sum of the embeddings of several hashes: of the word and of its first four to eight bytes, so that
inflected forms share what they have in common. Filters of several widths slide over the words of the whole text, the
largest response of each is kept, and a weighted sum of these gives the probability. Neither language nor source
nor id is an input. Thresholds of the decision are calibrated for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.classify import best_threshold, best_thresholds, labelled_rows, odds, probabilities, with_scores
from sluicebox.llm.hashing import Words, batches
from sluicebox.llm.work import small_batches, stored

BUCKETS = 1 << 16
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (None, 4, 5, 6, 7, 8)
# All labelled rows are learned from, whole, in shards of about so many rows and characters; a sixth is for calibration.
SHARD_ROWS = 9_000
SHARD_CHARS = 24_000_000
# Texts of a step are looked through together up to about so many words, a longer one alone.
SAMPLE_CHARS = 20_000
# Rows that Python gets at a time, and bytes of texts whose words have their features in memory at once, or one longer text.
BATCH_ROWS = 256
GROUP_BYTES = 1 << 18
# Steps on the first shard. All shards then go on from there in so many rounds, each with another part of their rows; after
# a round the mean of what they learned is the next start.
STEPS = 1_500
ROUNDS = 2
# Hashes in fewer of the texts are not learned: what hardly recurs could only be memorised.
LEAST_TEXTS = 4
BATCH = 32
RATE = 0.01
ROUND_RATE = 0.003
# Changes are summed as whole multiples of this, so that sums do not depend on their order.
UNIT = 2.0**-24
# The score at which a text counts as toxic where its language has no threshold of its own.
THRESHOLD = 0.3


def word_features(words: Words) -> np.ndarray:
    """A row of embedding numbers per word."""
    found = [words.hashes(prefix) ^ np.uint64(k * 0x1851F42D4C957F2D % (1 << 64)) for k, prefix in enumerate(PREFIXES)]
    return np.stack([(x >> np.uint64(64 - 16)).astype(np.int32) for x in found], axis=1)


@dataclass
class TextCnn:
    """``table`` has one row more than buckets: the last is zero and stands for the gaps between texts."""

    table: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: float = 0.0
    moments: dict = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int) -> TextCnn:
        draw = np.random.default_rng(seed)
        table = draw.normal(0, 0.1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
        table[BUCKETS] = 0
        filters = [draw.normal(0, 1 / np.sqrt(DIMENSIONS * w), (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        return cls(table, filters, biases, draw.uniform(0.1, 0.5, FILTERS * len(WIDTHS)).astype(np.float32))

    def _vectors(self, features: np.ndarray) -> np.ndarray:
        found = self.table[features[:, 0]]
        for k in range(1, features.shape[1]):
            found += self.table[features[:, k]]
        return found

    def _responses(self, vectors: np.ndarray) -> Iterator[np.ndarray]:
        """For each width, the filters' responses at each place. The last places have fewer words."""
        for weights, bias in zip(self.filters, self.biases, strict=True):
            found = vectors @ weights[0]
            for k in range(1, len(weights)):
                found[:-k] += vectors[k:] @ weights[k]
            yield found + bias

    def logits(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One per text; ``first`` holds each text's first row of ``features``, a gap ends each text."""
        vectors = self._vectors(features)
        spans = np.stack([first, _last_places(first, len(features))], axis=1).ravel()
        pooled = [np.maximum.reduceat(x, spans, axis=0)[::2] for x in self._responses(vectors)]
        return np.concatenate(pooled, axis=1) @ self.out + self.out_bias

    def _step(self, name: object, value: np.ndarray, gradient: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
        """Adam; of the table only the rows that took part."""
        if name not in self.moments:
            self.moments[name] = [np.zeros_like(value), np.zeros_like(value)]
        mean, square = self.moments[name]
        where = slice(None) if rows is None else rows
        mean[where] = 0.9 * mean[where] + 0.1 * gradient
        square[where] = 0.99 * square[where] + 0.01 * gradient**2
        value[where] -= rate * mean[where] / (np.sqrt(square[where]) + 1e-6)

    def _strongest(self, features: np.ndarray, first: np.ndarray) -> tuple[list, list, list]:
        """For each width, each text's largest responses, and the vectors and the features of the words they come from."""
        ends = _last_places(first, len(features))
        vectors = self._vectors(features)
        padded = np.concatenate([vectors, np.zeros((max(WIDTHS), DIMENSIONS), np.float32)])
        numbers = np.concatenate([features, np.full((max(WIDTHS), features.shape[1]), BUCKETS, np.int32)])
        pooled, seen, named = [], [], []
        for width, found in zip(WIDTHS, self._responses(vectors), strict=True):
            place = np.stack([a + found[a:b].argmax(axis=0) for a, b in zip(first.tolist(), ends.tolist(), strict=True)])
            pooled.append(np.take_along_axis(found, place, axis=0))
            seen.append(np.stack([padded[place + k] for k in range(width)]))
            named.append(np.stack([numbers[place + k] for k in range(width)]))
        return pooled, seen, named

    def train(self, texts: list[np.ndarray], labels: np.ndarray, rate: float) -> None:
        """One step on the features of some texts."""
        parts, size = [[]], 0
        for some in texts:
            if parts[-1] and size + len(some) > SAMPLE_CHARS:
                parts.append([])
                size = 0
            parts[-1].append(some)
            size += len(some)
        found = [self._strongest(*_joined(part)) for part in parts]
        pooled = [np.concatenate([x[0][i] for x in found]) for i in range(len(WIDTHS))]
        seen, named = ([np.concatenate([x[j][i] for x in found], axis=1) for i in range(len(WIDTHS))] for j in (1, 2))
        active = np.concatenate(pooled, axis=1)
        chance = 1 / (1 + np.exp(-np.clip(active @ self.out + self.out_bias, -30, 30)))
        wrong = ((chance - labels) / len(labels)).astype(np.float32)
        back = wrong[:, None] * self.out

        rows, gradients = [], []
        updates = []
        for i, weights in enumerate(self.filters):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            change = np.empty_like(weights)
            for k in range(len(weights)):
                change[k] = np.einsum("bfd,bf->df", seen[i][k], part)
                rows.append(named[i][k].reshape(-1, named[i].shape[-1]))
                gradients.append(np.einsum("bf,df->bfd", part, weights[k]).reshape(-1, DIMENSIONS))
            updates.append((i, change, part.sum(axis=0)))
        for i, change, bias in updates:
            self._step(("filter", i), self.filters[i], change, rate)
            self._step(("bias", i), self.biases[i], bias, rate)
        self._step("out", self.out, wrong @ active, rate)
        np.maximum(self.out, 0.01, out=self.out)  # so no word of a text takes away from what another one shows
        self.out_bias -= rate * float(wrong.sum())
        all_rows, gradient = np.concatenate(rows), np.concatenate(gradients)
        touched, inverse = np.unique(all_rows, return_inverse=True)
        total = np.zeros((len(touched), DIMENSIONS), np.float32)
        for k in range(all_rows.shape[1]):
            np.add.at(total, inverse.reshape(all_rows.shape)[:, k], gradient)
        keep = touched != BUCKETS
        self._step("table", self.table, total[keep], rate, touched[keep])

    def learn(self, features: list[np.ndarray], to_learn: np.ndarray, labels: np.ndarray, steps: int, rate: float, seed: int) -> None:
        """Steps on the texts in random order, again and again, with a falling rate; ``to_learn`` is what a feature stands for."""
        order, draw = np.arange(len(labels)), np.random.default_rng(seed)
        at = len(order)
        for step in range(steps):
            if at >= len(order):
                draw.shuffle(order)
                at = 0
            some, at = order[at : at + BATCH], at + BATCH
            self.train([to_learn[features[i]] for i in some], labels[some], rate * 0.1 ** (step / steps))
        self.moments = {}

    def numbers(self) -> np.ndarray:
        """All weights in rows: those of the buckets, then the others."""
        others = np.concatenate([x.ravel() for x in (*self.filters, *self.biases, self.out)] + [[self.out_bias]])
        others = np.pad(others, (0, -len(others) % DIMENSIONS)).reshape(-1, DIMENSIONS)
        return np.concatenate([self.table[:BUCKETS].astype(np.float64), others])

    def changed(self, change: np.ndarray) -> TextCnn:
        """A network whose ``numbers`` are these and the change."""
        found = (self.numbers() + change).astype(np.float32)
        table = np.concatenate([found[:BUCKETS], np.zeros((1, DIMENSIONS), np.float32)])
        parts, rest = [], found[BUCKETS:].ravel()
        for old in (*self.filters, *self.biases, self.out):
            parts.append(rest[: old.size].reshape(old.shape))
            rest = rest[old.size :]
        n = len(WIDTHS)
        return TextCnn(table, parts[:n], parts[n : 2 * n], parts[-1], float(rest[0]))


def _last_places(first: np.ndarray, size: int) -> np.ndarray:
    """Where each text's places end: behind the first row of its gap. Later ones would reach into the next text."""
    return np.append(first[1:], size) - max(WIDTHS) + 1


def _joined(some: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts behind one another, with a gap of the widest filter after each."""
    gap = np.full((max(WIDTHS), len(PREFIXES)), BUCKETS, np.int32)
    first = np.cumsum([0, *(len(x) + len(gap) for x in some[:-1])])
    return np.concatenate([part for x in some for part in (x, gap)]), first


def texts_features(texts: list[str | None]) -> Iterator[np.ndarray]:
    for _, group in batches(texts, GROUP_BYTES):
        words = Words(group)
        found = word_features(words).astype(np.uint16)  # half the memory, as a gap has no number here
        yield from np.split(found, words.first[1:-1])


@dataclass
class ToxicityModel:
    network: TextCnn
    shift: float
    thresholds: dict[str, float]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found = []
        for at, group in batches(texts):
            found.append(self.network.logits(*_joined(list(texts_features(texts[at : at + len(group)])))))
        logits = np.concatenate(found) if found else np.zeros(0)
        return probabilities(logits + self.shift)


def fit(texts: list[str | None], labels: list[int], languages: list[str | None], seed: int = 7) -> ToxicityModel:
    """A model of some labelled texts. The last sixth of them calibrates the score and the thresholds."""
    # Views of a few large arrays, whose memory goes back to the system afterwards.
    features = list(texts_features(texts))
    y = np.array(labels, dtype=np.float64)
    network = TextCnn.new(seed)
    model = ToxicityModel(network, 0.0, {})
    if not len(y) or y.min() == y.max():
        network.out[:] = 0
        model.shift = 4.0 if len(y) and y[0] else -4.0
        return model
    held = max(1, len(y) // 6)
    texts_with = np.zeros(BUCKETS + 1, np.int64)
    for some in features[: len(y) - held]:
        texts_with[np.unique(some)] += 1
    rare = np.flatnonzero(texts_with < LEAST_TEXTS)
    network.table[rare] = 0
    to_learn = np.arange(BUCKETS + 1, dtype=np.int32)
    to_learn[rare] = BUCKETS
    known = len(y) - held
    network.out_bias = _start_bias(y[:known].mean())
    network.learn(features[:known], to_learn, y[:known], STEPS, RATE, seed)
    kept = y[known:]
    scores = model.scores(texts[known:])
    best = best_threshold(scores, kept, 0.5)
    # The best split of the calibration rows becomes the common threshold.
    model.shift = odds(THRESHOLD) - odds(best)
    scores = model.scores(texts[known:])
    spoken = np.array([x or "" for x in languages[known:]])
    model.thresholds = {
        str(name): best_threshold(scores[spoken == name], kept[spoken == name], THRESHOLD) for name in np.unique(spoken) if name
    }
    return model


def _start_bias(share: float) -> float:
    return float(np.log((share + 1e-3) / (1 - share + 1e-3)))


def _texts_with(rows: DataFrame) -> np.ndarray:
    """In how many texts each bucket occurs."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_with = np.zeros(BUCKETS, np.int64)
        for batch in found:
            for some in texts_features(batch.column(0).to_pylist()):
                texts_with[np.unique(some)] += 1
        bucket = np.flatnonzero(texts_with)
        yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(texts_with[bucket])], names=["bucket", "n"])

    counts = rows.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    with small_batches(rows.sparkSession, BATCH_ROWS):
        counts = counts.toArrow()
    texts_with = np.zeros(BUCKETS + 1, np.int64)
    texts_with[counts.column(0).to_numpy()] = counts.column(1).to_numpy()
    return texts_with


def _learned(network: TextCnn, rows: DataFrame, to_learn: np.ndarray, steps: int | None, rate: float, seed: int) -> TextCnn:
    """The mean of what each shard of the rows makes of the network, in so many steps or once through its rows.

    A shard counts by its rows, and for a bucket only where it has met it. Tasks give sums, which Spark adds up.
    """
    shared = rows.sparkSession.sparkContext.broadcast((network, to_learn))
    values = [f"v{k}" for k in range(DIMENSIONS)]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, kept = shared.value
        before = start.numbers()
        total, weight = np.zeros(before.shape, np.int64), np.zeros(len(before), np.int64)

        def add(features: list[np.ndarray], labels: list[int]) -> None:
            own = start.changed(np.zeros_like(before))
            own.learn(features, kept, np.array(labels, dtype=np.float64), steps or -(-len(labels) // BATCH), rate, seed)
            change = np.rint((own.numbers() - before) / UNIT).astype(np.int64)
            met = change.any(axis=1)
            met[BUCKETS:] = True
            total[met] += change[met] * len(labels)
            weight[met] += len(labels)

        features, labels, at = [], [], None
        for batch in found:
            shards = batch.column(0).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if a == b:
                    continue
                if at is not None and shards[a] != at:
                    add(features, labels)
                    features, labels = [], []
                at = shards[a]
                features += texts_features(batch.column(1).slice(a, b - a).to_pylist())
                labels += batch.column(2).slice(a, b - a).to_pylist()
        if labels:
            add(features, labels)
        place = np.flatnonzero(weight)
        columns = [place.astype(np.int32), weight[place], *(total[place, k] for k in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["place", "weight", *values])

    schema = ", ".join(["place int", "weight long", *(f"{name} long" for name in values)])
    sums = rows.select("shard", "text", "label").mapInArrow(run, schema).groupBy("place").agg(*[F.sum(x).alias(x) for x in ("weight", *values)])
    with small_batches(rows.sparkSession, BATCH_ROWS):
        sums = sums.toArrow()
    change = np.zeros(network.numbers().shape)
    found = np.stack([sums.column(name).to_numpy() for name in values], axis=1)
    change[sums.column("place").to_numpy()] = found / sums.column("weight").to_numpy()[:, None] * UNIT
    return network.changed(change)


def fit_on(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", seed: int = 7
) -> ToxicityModel:
    """Fit on all labelled rows that may be learned from, see ``labelled_rows``, and on their whole texts.

    Counts, weights and thresholds come from all shards. Without such rows all texts get the same score: about 0.02, which is
    not toxic.
    """
    rows, shards = labelled_rows(docs, labels, label_col, SHARD_ROWS, SHARD_CHARS, id_col, text_col)
    to_fit = rows.where("NOT calibrates")
    n, hits = to_fit.agg(F.count("*"), F.sum("label")).first()
    if not n or hits in (0, n):
        return fit([], [int(bool(hits))] if n else [], [], seed)
    network = TextCnn.new(seed)
    rare = np.flatnonzero(_texts_with(to_fit) < LEAST_TEXTS)
    network.table[rare] = 0
    to_learn = np.arange(BUCKETS + 1, dtype=np.int32)
    to_learn[rare] = BUCKETS
    network.out_bias = _start_bias(hits / n)
    start = to_fit.where(F.col("shard") == to_fit.agg(F.min("shard")).first()[0])
    network = _learned(network, start, to_learn, STEPS, RATE, seed)
    for k in range(ROUNDS if shards > 1 else 0):
        part = to_fit.where(F.col("place") % ROUNDS == k)
        network = _learned(network, part, to_learn, None, ROUND_RATE * 0.1**k, seed + k)
    model = ToxicityModel(network, 0.0, {})
    scored = with_scores(rows.where("calibrates").select("label", "lang", "text"), model).select("score", "label", "lang")
    with small_batches(docs.sparkSession, BATCH_ROWS):
        scored = stored(scored, "calibration")
    best = best_thresholds(scored)
    # The best split of all calibration rows becomes the common threshold.
    model.shift = odds(THRESHOLD) - odds(best.pop("", 0.5))
    model.thresholds = {name: float(probabilities(odds(value) + model.shift)) for name, value in best.items()}
    return model


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The input with ``score``, from 0 to 1, and ``toxic``: whether it reaches the threshold of the row's language.

    NULL and empty texts have the score of no words. Languages without a threshold, and NULL, have THRESHOLD. Columns of
    the input with these names are replaced.
    """
    scored = with_scores(docs.drop("toxic"), model, text_col)
    threshold = F.lit(THRESHOLD)
    if "lang" in scored.columns:
        known = [F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair]
        if known:
            threshold = F.coalesce(F.try_element_at(F.create_map(*known), F.col("lang").cast("string")), threshold)
    return scored.withColumn("toxic", F.col("score") >= threshold)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows that are not toxic, with the columns of the input. They are written once, see ``small_batches``."""
    names = {name: f"__kept_{name}" for name in docs.columns if name in ("score", "toxic")}
    scored = score(docs.withColumnsRenamed(names), model, text_col).where("NOT toxic")
    kept = scored.drop("score", "toxic").withColumnsRenamed({new: name for name, new in names.items()}).select(docs.columns)
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return stored(kept, "clean")
