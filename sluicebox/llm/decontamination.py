"""Passages of benchmark items in documents, found by winnowing.

Of every WINDOW consecutive words the smallest hash of GRAM consecutive ones is kept as a fingerprint, so two texts with
WINDOW words in common share one. Fingerprints of documents are joined with those of the items, and each hit is extended to
the whole windows it is the smallest hash of, which are compared by two 64-bit hashes. An item of fewer words is one window
and its own fingerprint.

A filter of fixed size holds the items' fingerprints, and what of a document doesn't pass it is never shuffled. Documents
with equal text are one. Windows that occur in the same items are one class, and documents with the same classes share one
list of items, so that a passage of many items in many documents is not spelled out for each of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.hashing import NO_LETTER, Words, batches, mixed
from sluicebox.llm.ordered_hash import joined_sha256
from sluicebox.llm.work import small_batches, stored
from sluicebox.operators.skew import unique_side

WINDOW = 10
GRAM = 5
# Bits of the filter: 8 MB, which is the most that the driver gets and sends out.
FILTER_BITS = 1 << 26
# Bytes and words of a long text that are gone through at a time.
PIECE = 1 << 22
RUN = 1 << 18
BATCH_ROWS = 1_000
_SEPARATOR = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_EMPTY = hashlib.sha256().hexdigest()
_WINDOW_KEY = ["size", "w1", "w2"]


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of each text's words."""
    for _, group in batches(texts):
        if len(group) > 1 or len(group[0]) <= PIECE:
            words = Words(group, NO_LETTER)
            yield from np.split(words.hashes(), words.first[1:-1])
            continue
        raw, at, found = group[0], 0, []
        while at < len(raw):
            end = _SEPARATOR.search(raw, at + PIECE)
            end = end.start() if end else len(raw)
            found.append(Words([raw[at:end]], NO_LETTER).hashes())
            at = end
        yield np.concatenate(found)


def grams(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    found = np.full(max(0, len(words) - size + 1), seed * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for k in range(size):
        found = mixed(found + words[k : k + len(found)] + np.uint64(k + 1))
    return found


def windows(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``size`` words its fingerprint and two hashes of the whole."""
    first, second = grams(words, size, size), grams(words, size, size + 100)
    if size < WINDOW:
        return grams(words, size, size + 200), first, second
    parts = grams(words, GRAM, 300)
    least = parts[: len(first)]
    for k in range(1, WINDOW - GRAM + 1):
        least = np.minimum(least, parts[k : k + len(first)])
    return least, first, second


def _bits(fingerprints: np.ndarray) -> np.ndarray:
    return (fingerprints >> np.uint64(64 - FILTER_BITS.bit_length() + 1)).astype(np.int64)


def _item_windows(items: DataFrame) -> DataFrame:
    """``item``, the window's ``size``, fingerprint, the filter's bit of it, and hashes. Items without words have none."""
    schema = pa.schema([*[(name, pa.int64()) for name in ("item", "bit", "size", "fingerprint", "w1", "w2")]])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for item, words in zip(batch.column(0).to_pylist(), word_hashes(batch.column(1).to_pylist()), strict=True):
                size = min(len(words), WINDOW)
                if size:
                    least, first, second = windows(words, size)
                    same = pa.array([item] * len(first), pa.int64())
                    numbers = [_bits(least), np.full(len(first), size), *[x.view(np.int64) for x in (least, first, second)]]
                    yield pa.RecordBatch.from_arrays([same, *[pa.array(x, pa.int64()) for x in numbers]], schema=schema)

    return items.mapInArrow(run, "item long, bit long, size long, fingerprint long, w1 long, w2 long")


def _filter_of(item_windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The filter's bits as bytes, and the sizes of windows below WINDOW that there are."""
    place = F.col("bit") + 1
    parts = item_windows.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
    rows = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    found = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in rows:
        part = np.frombuffer(bytes(row.bits), dtype=np.uint8)
        found[(row.bucket - 1) * 4096 :][: len(part)] = part
    sizes = item_windows.where(F.col("size") < WINDOW).select("size").distinct().collect()
    return found, sorted(row.size for row in sizes)


def _marked(docs: DataFrame, bits: np.ndarray, short: list[int]) -> DataFrame:
    """Id, digest of the text, number of words, and the fingerprints that pass the filter.

    A fingerprint comes with the first of the consecutive windows it is the smallest hash of, and with all their hashes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    hit = pa.struct([("fingerprint", pa.int64()), ("size", pa.int64()), ("start", pa.int64()), ("w1", pa.list_(pa.int64())), ("w2", pa.list_(pa.int64()))])
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()), ("hits", pa.list_(hit))])

    def passing(words: np.ndarray) -> Iterator[dict]:
        table = shared.value
        for size in [*short, WINDOW]:
            for at in range(0, len(words) - size + 1, RUN):
                least, first, second = windows(words[at : at + RUN + size - 1], size)
                places = _bits(least)
                open_ = np.flatnonzero(table[places >> 3] >> (places & 7).astype(np.uint8) & 1)
                # Consecutive windows with the same fingerprint go together.
                starts = np.flatnonzero((np.diff(open_, prepend=-2) != 1) | (least[open_] != least[open_ - 1]))
                for some in np.split(open_, starts[1:]) if len(open_) else []:
                    a, b = some[0], some[-1] + 1
                    yield {
                        "fingerprint": int(least[a].view(np.int64)),
                        "size": size,
                        "start": int(a) + at,
                        "w1": first[a:b].view(np.int64).tolist(),
                        "w2": second[a:b].view(np.int64).tolist(),
                    }

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                hashed = list(word_hashes(texts))
                digests = [hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for text in texts]
                columns = [digests, [len(words) for words in hashed], [list(passing(words)) for words in hashed]]
                arrays = [pa.array(x, field.type) for x, field in zip(columns, list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], schema=schema)

    kind = "fingerprint bigint, size bigint, start bigint, w1 array<bigint>, w2 array<bigint>"
    return docs.mapInArrow(run, f"id long, digest binary, n_words long, hits array<struct<{kind.replace(' bigint', ':bigint').replace(' array', ':array')}>>")


def _set_key(*columns: str) -> list[Column]:
    """A key of a set of distinct rows: their number and the exclusive or of two hashes of each."""
    of = [F.bit_xor(F.xxhash64(F.lit(k), *columns)).alias(f"s{k}") for k in (1, 2)]
    return [F.count("*").alias("s0"), *of]


_SET = ["s0", "s1", "s2"]


def mark_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    Words are runs of letters and digits, with A-Z in lower case; all characters above ASCII count as letters. A window is
    WINDOW consecutive words of an item, or all words of an item with fewer. A document's words inside any occurrence of any
    window are hit. ``n_items`` counts the items of those windows, and ``items_sha256`` is the hash of their ids, sorted as
    text and joined by commas. NULL, empty and wordless texts have no words, no hits, and the hash of the empty text. Rows
    that repeat an item's id are one item with the windows of all. An item without an id has hits but is not counted.
    Repeated rows of documents give a row each. Ids are integers; other columns are ignored.
    """
    spark = docs.sparkSession
    with small_batches(spark, BATCH_ROWS):
        item_rows = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
        in_items = stored(_item_windows(item_rows).distinct(), "item_windows")
        bits, short = _filter_of(in_items)
        source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        marked = stored(_marked(source, bits, short), "fingerprints")

        # Join the fingerprints, and extend the hits to whole windows.
        once = marked.where("size(hits) > 0").select("digest", "hits").dropDuplicates(["digest"])
        fingerprints = once.select("digest", F.explode("hits").alias("hit")).select("digest", "hit.*")
        of_items = in_items.select(F.concat_ws(":", "size", "fingerprint").alias("print"))
        shared = fingerprints.withColumn("print", F.concat_ws(":", "size", "fingerprint")).join(unique_side(of_items, "print"), "print", "left_semi")
        extended = shared.select("digest", "size", "start", F.posexplode(F.arrays_zip("w1", "w2")).alias("nth", "w"))
        extended = extended.select("digest", "size", (F.col("start") + F.col("nth")).alias("start"), "w.w1", "w.w2")

        # The class of a window: which items have it.
        listed = in_items.where("item IS NOT NULL").groupBy(*_WINDOW_KEY, "item").agg(F.lit(1).alias("one"))
        classes = in_items.select(*_WINDOW_KEY).distinct().join(listed.groupBy(*_WINDOW_KEY).agg(*_set_key("item")), _WINDOW_KEY, "left")
        classes = stored(classes.withColumn("window", F.concat_ws(":", *_WINDOW_KEY)), "classes")
        of_window = unique_side(classes, "window", *[F.max(name).alias(name) for name in _SET])
        hits = extended.withColumn("window", F.concat_ws(":", *_WINDOW_KEY)).join(of_window, "window")
        hits = stored(hits.select("digest", "start", (F.col("start") + F.col("size")).alias("end"), *_SET), "hits")

        # Words hit, once each, from the windows in their order.
        order = Window.partitionBy("digest").orderBy("start", F.desc("end"))
        upto = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("upto", F.lit(0))))
        counted = hits.withColumn("upto", upto).groupBy("digest").agg(F.sum(fresh).alias("n_hit"))

        # Documents with the same classes share one list of items.
        has = hits.where("s0 IS NOT NULL").select("digest", *_SET).distinct()
        of_digest = has.groupBy("digest").agg(*[column.alias(f"of_{k}") for k, column in enumerate(_set_key(*_SET))])
        of_digest = stored(of_digest.withColumn("key", F.concat_ws(":", "of_0", "of_1", "of_2")).select("digest", "key"), "sets")
        drawn = of_digest.groupBy("key").agg(F.min("digest").alias("digest"))
        of_class = classes.where("s0 IS NOT NULL").groupBy(*_SET).agg(F.min(F.struct(*_WINDOW_KEY)).alias("w")).select(*_SET, "w.*")
        lists = of_class.join(listed, _WINDOW_KEY).select(*_SET, "item")
        found = drawn.join(has, "digest").join(lists, _SET).select("key", F.col("item").cast("string").alias("value")).distinct()
        found = stored(found, "items")
        hashes = joined_sha256(found, name="items_sha256").join(found.groupBy("key").agg(F.count("*").alias("n_items")), "key")
        of_digest = of_digest.join(unique_side(hashes, "key", F.max("n_items").alias("n_items"), F.max("items_sha256").alias("items_sha256")), "key")
        results = stored(counted.join(of_digest, "digest", "left").drop("key"), "results")

    measures = [F.max(name).alias(name) for name in ("n_hit", "n_items", "items_sha256")]
    joined = marked.select("id", "digest", "n_words").join(unique_side(results, "digest", *measures), "digest", "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.lit(_EMPTY)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
