"""Language by the nearest centroid of n-gram vectors.

A text's vector holds the counts of its hashed n-grams of letters, damped, weighted by how rare they are in all texts
to learn from, and scaled to length 1. Each language has several centroids, clustered by cosine from a sample. A text
gets the language of the nearest one, and is marked as rejected when it is farther away than nearly all of the
language's own texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluicebox.llm.classify import spread
from sluicebox.llm.hashing import batches

BUCKETS = 1 << 12
ORDERS = (1, 2, 3)
CENTROIDS = 4
ROUNDS = 10
# The centroids are fitted on at most so many texts of a language, those whose ids hash lowest; longer texts than this are
# learned from in slices spread over the whole text. Many languages share SAMPLE_TOTAL texts, with LEAST_ROWS each at least.
SAMPLE_ROWS = 1_500
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = 24_000
LEAST_ROWS = 50
MOST_LANGUAGES = 500
# Share of a language's sample that is farther away than what is accepted.
REJECTED = 0.001
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
# Bytes of letters, and a space for all others. Bytes from 128 belong to letters for the most part.
_KEPT = np.full(256, 32, dtype=np.uint32)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def counts(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For some texts at a time, how often each n-gram occurs in each text."""
    for _, group in batches([None if text is None else text.lower() for text in texts]):
        lengths = np.array([len(raw) + 2 for raw in group])
        symbols = _KEPT[np.frombuffer(b"".join([b" " + raw + b" " for raw in group]), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(group)), lengths)
        found = np.zeros(len(group) * BUCKETS)
        gram = np.zeros(len(symbols), dtype=np.uint32)
        for order in range(1, max(ORDERS) + 1):
            gram = gram[: len(symbols) - order + 1] * np.uint32(256) + symbols[order - 1 :]
            if order not in ORDERS:
                continue
            same = owner[: len(gram)] == owner[order - 1 :]
            # Not the gaps between words.
            same &= (symbols[: len(gram)] != 32) | (symbols[order - 1 :] != 32)
            hashed = ((gram * np.uint32(_FACTORS[order - 1]) + np.uint32(order)) * np.uint32(0x27D4EB2F)) >> np.uint32(20)
            found += np.bincount(owner[: len(gram)][same] * BUCKETS + hashed[same], minlength=len(found))
        yield found.reshape(len(group), BUCKETS)


def vectors(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    scaled = np.log1p(found) * weights
    length = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return scaled / np.where(length == 0, 1, length)[:, None]


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of length 1. The first is the mean, each further one starts at the text farthest from those before."""
    centres = [x.mean(axis=0)]
    nearest = x @ (centres[0] / max(np.linalg.norm(centres[0]), 1e-12))
    for _ in range(1, min(k, len(x))):
        centres.append(x[nearest.argmin()])
        nearest = np.maximum(nearest, x @ centres[-1])
    found = np.array(centres)
    for _ in range(ROUNDS):
        found /= np.maximum(np.linalg.norm(found, axis=1), 1e-12)[:, None]
        own = (x @ found.T).argmax(axis=1)
        for i in range(len(found)):
            if (own == i).any():
                found[i] = x[own == i].mean(axis=0)
    return found / np.maximum(np.linalg.norm(found, axis=1), 1e-12)[:, None]


@dataclass
class LanguageModel:
    weights: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    owners: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float, bool]]:
        """Language, cosine to its nearest centroid, and whether the text is too far away."""
        rows = (row for found in counts(texts) for row in self._nearest(found))
        for text, (owner, cosine) in zip(texts, rows, strict=True):
            if text is None or owner is None or not _LETTER.search(text):
                yield UNKNOWN, 0.0, True
            else:
                yield self.languages[owner], cosine, cosine < self.least[owner]

    def _nearest(self, found: np.ndarray) -> Iterator[tuple[int | None, float]]:
        if not self.languages:
            yield from ((None, 0.0) for _ in found)
            return
        cosines = vectors(found, self.weights) @ self.centroids.T
        best = cosines.argmax(axis=1)
        top = np.clip(cosines[np.arange(len(best)), best], 0, 1)
        yield from zip(self.owners[best].tolist(), top.tolist(), strict=True)


def learned_from(row_id: Column) -> Column:
    """Whether a row's text and language may be learned from. Rows without an id are in neither part."""
    return F.coalesce(F.crc32(row_id.cast("string")) % 5 != 0, F.lit(False))


def held_out(row_id: Column) -> Column:
    return F.coalesce(F.crc32(row_id.cast("string")) % 5 == 0, F.lit(False))


def _rarity(texts: DataFrame) -> np.ndarray:
    """A weight for each n-gram from the number of texts that have it, counted over all texts."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                for some in counts(batch.slice(at, 512).column(0).to_pylist()):
                    total += (some > 0).sum(axis=0)
                    rows += len(some)
        numbers = np.append(np.arange(BUCKETS), -1)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(np.append(total, rows), pa.int64())], names=["gram", "n"])

    # One row for each bucket.
    summed = texts.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    total = {row.gram: row.n for row in summed}
    having = np.array([total.get(gram, 0) for gram in range(BUCKETS)])
    return np.log((1 + total.get(-1, 0)) / (1 + having)) + 1


def fit_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang") -> LanguageModel:
    """Fit on the rows that may be learned from: rarities on all of them, centroids on a bounded sample of each language.

    A language is clustered in one task, and the driver gets the centroids. Of more than MOST_LANGUAGES different values
    the most frequent are learned. A language whose sample has no letter is not learned.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{language_col}`").cast("string").alias("lang")
    ).where(learned_from(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    weights = _rarity(rows)
    # Hashes below a bound drawn from the counts hold about twice the sample, so that a common language does not come
    # together in one task; the lowest of them are taken.
    counted = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    totals = {row.lang: row.n for row in counted.collect()}
    if not totals:
        return LanguageModel(weights, np.zeros((0, BUCKETS)), [], np.zeros(0, dtype=np.int64), np.zeros(0))
    most = min(SAMPLE_ROWS, max(LEAST_ROWS, SAMPLE_TOTAL // len(totals)))
    share = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, 2 * most / n + 10 / n)])[F.col("lang")]
    hashed = rows.select("id", "lang", F.xxhash64("id").alias("hash"))
    low = hashed.where(F.col("hash") / F.lit(2.0**64) + 0.5 < share)
    order = Window.partitionBy("lang").orderBy("hash", "id")
    sample = low.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).select("id", "lang").distinct()
    slices = rows.select("id", "lang", spread(F.col("text"), SAMPLE_CHARS).alias("text"))
    found = slices.join(F.broadcast(sample), ["id", "lang"]).groupBy("lang", "id").agg(F.min("text").alias("text"))
    placed = found.repartition(len(totals), "lang").sortWithinPartitions("lang", "id").select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("centroids", pa.binary()), ("least", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for batch in batches for pair in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        for lang, some in groupby(pairs, key=lambda pair: pair[0]):
            texts = [text for _, text in some if _LETTER.search(text)]
            if texts:
                x = np.concatenate([vectors(part, weights).astype(np.float32) for part in counts(texts)])
                own = cluster(x, CENTROIDS)
                least = float(np.quantile((x @ own.T).max(axis=1), REJECTED))
                yield pa.RecordBatch.from_pylist([{"lang": lang, "centroids": own.tobytes(), "least": least}], schema=schema)

    models = sorted(placed.mapInArrow(run, "lang string, centroids binary, least double").collect())
    centroids = [np.frombuffer(row.centroids, np.float32).reshape(-1, BUCKETS) for row in models]
    owners = np.repeat(np.arange(len(models)), [len(own) for own in centroids]) if models else np.zeros(0, dtype=np.int64)
    stacked = np.concatenate(centroids) if centroids else np.zeros((0, BUCKETS))
    return LanguageModel(weights, stacked, [row.lang for row in models], owners, np.array([row.least for row in models]))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The input with ``lang_pred``, ``score`` and ``rejected``.

    NULL texts and texts without a letter are ``und`` with a score of 0, and rejected. All others have the nearest
    language, also where they are rejected. Without any text to learn from, all are ``und``. Columns of the input with
    these names are replaced.
    """
    names = ("lang_pred", "score", "rejected")
    kept = [name for name in docs.columns if name not in names]
    source = docs.select(*[F.col(f"`{name}`") for name in kept], F.col(f"`{text_col}`").cast("string").alias("__text"))
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(*field) for field in zip(names, kinds, strict=True)]])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = zip(*shared.value.predict(part.column(len(kept)).to_pylist()), strict=True) if part.num_rows else [[], [], []]
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *arrays], schema=arrow)

    return source.mapInArrow(run, schema)
