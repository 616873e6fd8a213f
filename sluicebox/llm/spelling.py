"""Spelling variants: words one letter apart, found in a bidirectional FM-index over the vocabulary.

If two words are one error apart, the error lies in one half of the first, so the other half occurs in both, at the same
end. A search matches either half and the end of the word exactly and goes on across the other half with one error.

The vocabulary is dealt out by these halves: a word is indexed with every half that a word of its length, or of one letter
more or less, may ask for, and asks with its own two. A task indexes some of these groups at a time, at most CHARS
letters; a larger group is cut into several indexes and each of its words is searched in all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.fm_index import LEFT, RIGHT, BidirectionalIndex, numbers
from sluicebox.llm.work import small_batches, stored
from sluicebox.operators.skew import unique_side

LEAST_LETTERS = 7
LEAST_COUNT = 2
# A form occurs so many times as often as its variant.
RATIO = 10
# A run whose CRC-32 this divides loses a letter.
DAMAGED = 31
# Letters of an index, words of a group in one index, and words of a task.
CHARS = 1 << 16
GROUP_WORDS = 4_000
TASK_WORDS = 20_000
# Longer words are compared with those that have a half in common, without an index.
LONG = 1_000
BATCH_ROWS = 1_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n``: words of LEAST_LETTERS and more letters that occur LEAST_COUNT times and more.

    A run of letters is put in lower case (A-Z only). Where DAMAGED divides the CRC-32 h of ``<id>:<run>``, the run loses
    its letter number h % length, from 0. A NULL id counts as empty text, a NULL text has no words.
    """
    # Shorter runs cannot become such words.
    runs = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS), F.lit(0))
    row_id = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    found = docs.select(row_id.alias("id"), F.explode(runs).alias("run")).select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    found = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run"))).withColumn("at", F.expr("int(h % length(run))"))
    damaged = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    words = found.select(F.when(F.col("h") % DAMAGED == 0, damaged).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _half(size: Column, side: int) -> Column:
    """Letters of a word of this size that match exactly when the search goes to a side."""
    first = F.floor(size / 2).cast("int")
    return first if side == RIGHT else size - first


def _halves(side: int) -> Column:
    """Halves of ``word`` that words of about its length ask for on a side; its own is one of them, and it asks for that."""
    length = F.length("word")
    parts = F.array_distinct(F.transform(F.sequence(length - 1, length + 1), lambda size: _half(size, side)))
    return F.transform(parts, lambda part: F.struct(F.lit(side).alias("side"), part.alias("part"), (part == _half(length, side)).alias("asks")))


def _near_in_index(words: DataFrame, tasks: int) -> DataFrame:
    """Pairs ``word``, ``near`` with the ``near_n`` of the second, of words of at most LONG letters."""
    dealt = words.select(F.explode(F.concat(_halves(RIGHT), _halves(LEFT))).alias("group"), "word", "n").select("group.*", "word", "n")
    key = F.when(F.col("side") == RIGHT, F.expr("left(word, part)")).otherwise(F.expr("right(word, part)"))
    dealt = dealt.select("side", key.alias("key"), "asks", "word", "n").withColumn("group", F.concat_ws(":", "side", "key"))
    large = unique_side(dealt, "group", F.ceil(F.count("*") / GROUP_WORDS).cast("int").alias("blocks")).where("blocks > 1")
    dealt = dealt.join(large, "group", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    indexed = dealt.select("side", "key", own.alias("block"), F.lit(0).alias("turn"), "word", "n", (F.col("asks") & (F.col("blocks") == 1)).alias("asks"))
    asked = dealt.where("blocks > 1 AND asks").select(
        "side", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("turn"), "word", "n", "asks"
    )
    group = ["side", "key", "block"]
    placed = indexed.union(asked).repartition(tasks, *group).sortWithinPartitions(*group, "turn", "word")
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def pairs(index: BidirectionalIndex, side: int, held: list[tuple[str, int]], queries: list[str]) -> pa.RecordBatch:
        columns = [[], [], []]
        for length, some in groupby(sorted(queries, key=len), key=len):
            some = list(some)
            letters = numbers("".join(some)).reshape(len(some), length)
            rows, found = index.near(letters, length // 2, side)
            for row, number in np.unique(np.stack([rows, found], axis=1), axis=0).tolist():
                word, n = held[number]
                if word != some[row]:
                    for column, value in zip(columns, (some[row], word, n), strict=True):
                        column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        held: dict[str, int] = {}
        asking: list[str] = []
        chars, held_side = 0, RIGHT

        def of_held() -> Iterator[pa.RecordBatch]:
            if asking:
                yield pairs(BidirectionalIndex(list(held)), held_side, list(held.items()), asking)

        for (side, _, _), some in groupby(rows, key=lambda row: row[:3]):
            index, own, queries = None, {}, []
            for _, _, _, turn, word, n, asks in some:
                if turn == 0:
                    own[word] = n
                elif index is None:
                    index = BidirectionalIndex(list(own))
                if asks:
                    queries.append(word)
                if index and len(queries) == GROUP_WORDS:
                    yield pairs(index, side, list(own.items()), queries)
                    queries = []
            if index:
                yield pairs(index, side, list(own.items()), queries)
                continue
            # A word alone has none near it here, and one that nobody asks about neither.
            if len(own) == 1 or not queries:
                continue
            if side != held_side or chars > CHARS:
                yield from of_held()
                held, asking, chars, held_side = {}, [], 0, side
            held |= own
            asking += queries
            chars += sum(len(word) + 1 for word in own)
        yield from of_held()

    return placed.mapInArrow(run, "word string, near string, near_n long")


def _near_long(words: DataFrame) -> DataFrame:
    """The same pairs of words of at least LONG letters."""
    size = F.length("word")
    long = words.where(size >= LONG).withColumn("size", size)
    halves = F.array(
        F.struct(F.lit(RIGHT).alias("side"), F.expr("left(word, size DIV 2)").alias("half")),
        F.struct(F.lit(LEFT).alias("side"), F.expr("right(word, size - size DIV 2)").alias("half")),
    )
    asked = long.select("word", "size", F.explode(halves).alias("h")).select("word", "h.side", F.length("h.half").alias("part"), F.sha2("h.half", 256).alias("half"))
    parts = F.array_distinct(F.expr("transform(array(size - 1, size, size + 1), x -> x DIV 2)"))
    others = F.array_distinct(F.expr("transform(array(size - 1, size, size + 1), x -> x - x DIV 2)"))
    first = long.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.lit(RIGHT).alias("side"), F.explode(parts).alias("part"))
    last = long.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.lit(LEFT).alias("side"), F.explode(others).alias("part"))
    first = first.withColumn("half", F.sha2(F.expr("left(near, part)"), 256))
    last = last.withColumn("half", F.sha2(F.expr("right(near, part)"), 256))
    met = asked.join(first.union(last), ["side", "part", "half"]).where("word <> near").select("word", "near", "near_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one_apart(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield batch.filter(pa.array(found, pa.bool_()))

    return met.mapInArrow(run, "word string, near string, near_n long")


def one_apart(a: str, b: str) -> bool:
    """Whether one letter put in, left out or replaced makes one of the other."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if len(b) - len(a) > 1 or a == b:
        return False
    differ = np.flatnonzero(numbers(a) != numbers(b)[: len(a)])
    at = int(differ[0]) if len(differ) else len(a)
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of the ``vocabulary``: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    Words are near if one becomes the other by one letter put in, left out or replaced; ``n_near`` counts the near words.
    The ``form`` is the near word that occurs most often, of several the first in code-point order, if it occurs at least
    RATIO times as often as the word, else NULL. The ``root`` follows the forms to the last; it is the word itself if there
    is none. Repeated rows count each time; an empty table has no words. Other columns are ignored.
    """
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return _forms(stored(vocabulary(docs, id_col, text_col), "vocabulary"))


def _forms(words: DataFrame) -> DataFrame:
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, 1 + 2 * words.count() // TASK_WORDS)
    pairs = _near_in_index(words.where(F.length("word") <= LONG), tasks).union(_near_long(words)).distinct()
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    stats = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    is_form = F.col("n_near").isNotNull() & (-F.col("best.order") >= RATIO * F.col("n"))
    found = words.join(stats, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.order")).alias("form_n"),
    )
    found = stored(found, "forms")
    # A form occurs RATIO times as often as its word, so a path has less than 19 steps. Each round doubles the steps taken.
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(5):
        further = unique_side(roots.select(F.col("word").alias("root"), F.col("root").alias("last")), "root", F.max("last").alias("last"))
        joined = stored(roots.join(further, "root", "left").select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")), "roots")
        roots = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
