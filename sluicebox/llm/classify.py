"""What the text classifiers share: which rows they learn from, thresholds, and scoring whole tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluicebox.sources.scratch import new_folder

# Rows of either label that a threshold needs.
LEAST_ROWS = 20
# A long text is learned from in so many slices.
SLICES = 8
# Characters of a sample that a model is fitted on at most.
SAMPLE_TOTAL = 24_000_000


class Scorer(Protocol):
    def scores(self, texts: list[str | None]) -> np.ndarray: ...


def probabilities(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.asarray(logits, dtype=np.float64), -30, 30)))


def odds(probability: float) -> float:
    """Log odds."""
    bounded = min(max(float(probability), 1e-13), 1 - 1e-13)
    return float(np.log(bounded / (1 - bounded)))


def best_threshold(scores: np.ndarray, labels: np.ndarray, default: float) -> float:
    """Half-way, in log odds, between the scores whose separation has the best F1; ``default`` where a label is rare."""
    if min(labels.sum(), len(labels) - labels.sum()) < LEAST_ROWS:
        return default
    order = np.argsort(-scores, kind="stable")
    scores, hits = scores[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(scores) + 1) + labels.sum())
    f1[:-1][scores[:-1] == scores[1:]] = 0  # equal scores cannot be separated
    at = int(f1.argmax())
    return float(probabilities((odds(scores[at]) + odds(scores[min(at + 1, len(scores) - 1)])) / 2))


def learned_from(row_id: Column) -> Column:
    """Whether the labels of a row may be learned from. Rows without an id are in neither part."""
    return F.coalesce(F.crc32(row_id.cast("string")) % 4 != 2, F.lit(False))


def held_out(row_id: Column) -> Column:
    return F.coalesce(F.crc32(row_id.cast("string")) % 4 == 2, F.lit(False))


def spread(text: Column, chars: int) -> Column:
    """The whole text or, of one of more than ``chars`` characters, SLICES of it at even distances from its first to its last."""
    each = chars // SLICES
    step = (F.length(text) - each) / (SLICES - 1)
    slices = [F.substring(text, (F.floor(step * k) + 1).cast("int"), F.lit(each)) for k in range(SLICES)]
    return F.when(F.length(text) > chars, F.concat_ws("\n", *slices)).otherwise(text)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, rows: int, chars: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """At most ``rows`` labelled rows, those whose ids hash lowest, in the order of another hash and in one partition.

    Only ids that occur in both tables are chosen from. The columns are ``id``, ``text``, ``label`` and ``lang``. A text of
    more than ``chars`` characters is a ``spread`` of it. Of repeated ids one row is taken, of their labels the larger;
    labels other than 0 and 1 are left out. Where no row may be learned from, the sample is empty.
    """
    ids = docs.select(F.col(f"`{id_col}`").alias("id"))
    sample = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(learned_from(F.col("id")) & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .join(ids, "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), spread(text, chars).alias("text"), language.alias("lang"))
    found = texts.join(F.broadcast(sample), "id").groupBy("id").agg(F.min(F.struct("text", "label", "lang")).alias("row"))
    order = [F.crc32(F.col("id").cast("string")), "id"]
    return found.select("id", "row.*").repartition(1).sortWithinPartitions(*order)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, rows: int, chars: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, int]:
    """All labelled rows that may be learned from, written in shards, and the number of shards.

    A shard holds about ``rows`` rows and ``chars`` characters, by the hash of the id and in the order of another one. The
    columns are ``shard``, ``place`` (a number of 24 bits from the id), ``calibrates`` (a sixth of the rows), ``text`` (whole),
    ``label`` and ``lang``. Repeated ids and labels are treated as in ``labelled_sample``. Texts are shuffled once.
    """
    row_id, language = F.col(f"`{id_col}`"), F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    found = docs.where(learned_from(row_id)).select(row_id.alias("id"), text.alias("text"), language.alias("lang"))
    marks = labels.select(row_id.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    marks = marks.where(learned_from(F.col("id")) & F.col("label").isin(0, 1))
    kind = T.StringType() if found.schema["id"].dataType != marks.schema["id"].dataType else found.schema["id"].dataType
    found, marks = found.withColumn("id", F.col("id").cast(kind)), marks.withColumn("id", F.col("id").cast(kind))
    size = found.select("id", F.length("text").alias("chars")).join(marks, "id", "left_semi").agg(F.count("*"), F.sum("chars")).first()
    shards = max(1, -(-size[0] // rows), -(-(size[1] or 0) // chars))
    none = F.lit(None)
    both = found.select("id", F.struct("text", "lang").alias("row"), none.cast("int").alias("label")).unionByName(
        marks.select("id", none.cast("struct<text:string,lang:string>").alias("row"), "label")
    )
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")
    merged = both.select(shard, "*").repartition(shards, "shard").groupBy("shard", "id").agg(F.min("row").alias("row"), F.max("label").alias("label"))
    code = F.crc32(F.col("id").cast("string"))
    merged = merged.where("row IS NOT NULL AND label IS NOT NULL").sortWithinPartitions("shard", code, "id").select(
        "shard",
        F.shiftright(code, 8).cast("int").alias("place"),
        (code >= (1 << 32) // 6 * 5).alias("calibrates"),
        "row.text",
        "label",
        "row.lang",
    )
    path = new_folder(docs.sparkSession, "labelled")
    merged.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(merged.schema).parquet(path), shards


def best_thresholds(scored: DataFrame) -> dict[str, float]:
    """``best_threshold`` of all rows, as "", and of those of each language, where no label is rare.

    Rows have ``score``, ``label`` and ``lang``. Equal scores are counted together; running counts are taken within narrow
    ranges of scores and added to those of the ranges above.
    """
    group = F.explode(F.array_distinct(F.array(F.lit(""), F.coalesce("lang", F.lit(""))))).alias("group")
    level = F.floor(F.log(F.col("score") / (1 - F.col("score"))) * 16).alias("level")
    counts = scored.select(group, "score", "label").groupBy("group", "score").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    counts = counts.select("*", level)
    above = Window.partitionBy("group").orderBy(F.desc("level"))
    before = above.rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy("group", "level").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max("score").alias("top"))
    ranges = ranges.select(
        "group",
        "level",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("hits").over(before), F.lit(0)).alias("hits_above"),
        F.lead("top").over(above).alias("below"),
        F.sum("n").over(Window.partitionBy("group")).alias("n_all"),
        F.sum("hits").over(Window.partitionBy("group")).alias("hits_all"),
    ).where(F.least("hits_all", F.expr("n_all - hits_all")) >= LEAST_ROWS)
    order = Window.partitionBy("group", "level").orderBy(F.desc("score"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    f1 = 2 * (F.col("hits_above") + F.sum("hits").over(upto)) / (F.col("n_above") + F.sum("n").over(upto) + F.col("hits_all"))
    following = F.coalesce(F.lead("score").over(order), "below", "score")
    best = counts.join(ranges, ["group", "level"]).select("group", "score", following.alias("following"), f1.alias("f1"))
    best = best.groupBy("group").agg(F.max(F.struct("f1", "score", "following")).alias("best")).select("group", "best.*")
    return {row.group: float(probabilities((odds(row.score) + odds(row.following)) / 2)) for row in best.collect()}


def fitted(sample: DataFrame, fit: Callable[[list[str], list[int], list[str | None]], Scorer]) -> Scorer:
    """``fit`` of a sample's texts, labels and languages, in one task; the driver gets the model alone.

    Of a sample of more than SAMPLE_TOTAL characters, the rows that come first are learned from.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels, languages, size = [], [], [], 0
        for batch in found:
            for text, label, lang in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                size += len(text)
                if size <= SAMPLE_TOTAL:
                    texts.append(text)
                    labels.append(label)
                    languages.append(lang)
        raw = pickle.dumps(fit(texts, labels, languages))
        yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["model"])

    found = sample.mapInArrow(run, "model binary").first()
    return pickle.loads(found.model) if found else fit([], [], [])  # an empty table may have no task at all


def with_scores(docs: DataFrame, model: Scorer, text_col: str = "text") -> DataFrame:
    """The input with the model's ``score`` of the whole text; a column of that name is replaced."""
    kept = [name for name in docs.columns if name != "score"]
    source = docs.select(*[F.col(f"`{name}`") for name in kept])
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])
    # A text that is among the columns goes to Python once.
    at_text = next((k for k, x in enumerate(source.schema) if x.name == text_col and x.dataType == T.StringType()), len(kept))
    if at_text == len(kept):
        text = F.col(f"`{text_col}`").cast("string").alias("__scored_text")
        source = docs.select(*[F.col(f"`{name}`") for name in kept], text)
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = shared.value.scores(part.column(at_text).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], pa.array(scores, pa.float64())], schema=arrow)

    return source.mapInArrow(run, schema)
