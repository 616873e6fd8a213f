"""Near duplicates by MinHash.

Documents with equal shingle sets are one node. A node's signature holds the minima of many universal hash functions;
bands of it give buckets. A bucket is never paired with itself. Its nodes are compared with its smallest and its largest
node; then, in a few rounds, the nodes outside a bucket's largest component with some nodes of that component. Nodes
that are connected already need no further link, so few are left, and these are held against the whole bucket, in
blocks of signatures. Candidates are estimated from their signatures and then confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sluicebox.llm.components import components
from sluicebox.llm.hashing import Words, batches, mixed
from sluicebox.llm.work import small_batches, stored
from sluicebox.operators.skew import unique_side

SHINGLE_WORDS = 5
# Links need percent * union <= 100 * intersection.
PERCENT = 80
# A pair at 0.8 shares no band with a chance of (1 - 0.8 ** 5) ** 30 = 7e-6.
BANDS, ROWS = 30, 5
# Share of equal signature values that a candidate needs. At a similarity of 0.8 the share is lower with a chance of 1e-5.
LEAST_ESTIMATE = 0.66
# Rounds in which the nodes outside a bucket's largest component are compared with so many nodes of it.
ROUNDS, CENTRES = 1, 6
# Nodes in one side of a block, and bytes of their sets that a task holds.
BLOCK = 2048
BLOCK_BYTES = 32 << 20
# A document's shingles are hashed in runs of so many, which bounds the memory for very long texts.
_RUN = 1 << 13
# Rows that Python gets at a time; those with texts or sets are large.
BATCH_ROWS = 1_000

_random = np.random.default_rng(20240607)
_A = _random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; of a text with fewer words, that of the whole sequence."""
    for _, group in batches(texts):
        found = Words(group)
        hashes = found.hashes()
        sums = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
        for k in range(words):
            sums = mixed(sums + hashes[k : k + len(sums)] + np.uint64(k + 1))
        for first, end in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
            if end - first >= words:
                yield np.unique(sums[first : end - words + 1])
            elif end > first:
                whole = np.zeros(1, dtype=np.uint64)
                for k in range(first, end):
                    whole = mixed(whole + hashes[k] + np.uint64(k - first + 1))
                yield mixed(whole + np.uint64(end - first))
            else:
                yield np.zeros(0, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of the universal hashes (a * x + b) >> 32 of the shingles."""
    x = shingles >> np.uint64(32)
    least = None
    for at in range(0, len(x), _RUN):
        run = ((x[None, at : at + _RUN] * _A[:, None] + _B[:, None]) >> np.uint64(32)).min(axis=1)
        least = run if least is None else np.minimum(least, run)
    return least


def band_hashes(minima: np.ndarray) -> np.ndarray:
    bands = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in minima.reshape(BANDS, ROWS).T:
        bands = mixed(bands + row)
    return bands.view(np.int64)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether ``100 * intersection >= percent * union`` for two sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # merges the two
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def _arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                columns = list(zip(*function(batch.slice(at, 512)), strict=True)) or [[] for _ in arrow]
                arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, kind)


def _features(docs: DataFrame, words: int) -> DataFrame:
    """Id, set size, digest of the set, band hashes and signature. Empty sets and rows without an id have no digest."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids = batch.column(0).to_pylist()
        for doc, shingles in zip(ids, shingle_sets(batch.column(1).to_pylist(), words), strict=True):
            if doc is None or not len(shingles):
                yield doc, len(shingles), None, None, None
                continue
            minima = signature(shingles)
            yield doc, len(shingles), _digest(shingles), band_hashes(minima), minima.astype(np.uint8).tobytes()

    return _arrow_map(docs, rows, "id long, n_shingles long, digest binary, bands array<long>, signature binary")


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """The sets of some texts, once each, and their digests."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        return ((_digest(x), x.tobytes()) for x in shingle_sets(batch.column(0).to_pylist(), words))

    return _arrow_map(docs.select("text"), rows, "digest binary, shingles binary").dropDuplicates(["digest"])


def _similar(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in a share of LEAST_ESTIMATE."""
    one = signatures.select(F.col("id").alias("a"), F.col("signature").alias("left"))
    other = signatures.select(F.col("id").alias("b"), F.col("signature").alias("right"))

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        if batch.num_rows:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8) for k in (2, 3))
            same = (left == right).reshape(batch.num_rows, -1).mean(axis=1) >= LEAST_ESTIMATE
            for a, b, ok in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), same.tolist(), strict=True):
                if ok:
                    yield a, b

    found = pairs.join(one, "a").join(other, "b").select("a", "b", "left", "right")
    return _arrow_map(found, rows, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    other = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for a, b, left, right in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if similar(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), percent):
                yield a, b

    found = pairs.join(one, "a").join(other, "b").select("a", "b", "left", "right")
    return _arrow_map(found, rows, "a long, b long")


def _pairs(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _to_ends(members: DataFrame) -> DataFrame:
    """Each node with the smallest and with the largest node of each of its buckets."""
    met = members.select("id", F.explode(F.array("low", "high")).alias("end")).where("id <> end")
    return met.select(*_pairs("id", "end")).distinct()


def _open(members: DataFrame, found: DataFrame, seed: int) -> DataFrame:
    """The members of buckets with several components: their component, and the bucket's largest with CENTRES of it."""
    known = found.select(F.col("node").alias("id"), "component")
    members = members.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    drawn = [F.min(F.struct(F.xxhash64("id", F.lit(seed + k)), "id")).alias(f"drawn_{k}") for k in range(CENTRES)]
    parts = members.groupBy("band", "component").agg(F.count("*").alias("n"), *drawn)
    centres = F.array_distinct(F.array(*[F.col(f"drawn_{k}.id") for k in range(CENTRES)])).alias("centres")
    largest = parts.select("band", F.struct("n", "component", centres).alias("part"))
    largest = unique_side(largest, "band", F.count("*").alias("parts"), F.max("part").alias("part")).where("parts > 1")
    return members.join(largest, "band").selectExpr("band", "id", "component", "part.component AS main", "part.centres", "part.n")


def _to_centres(open_buckets: DataFrame) -> DataFrame:
    few = open_buckets.where("component <> main").select("id", F.explode("centres").alias("centre"))
    return few.select(*_pairs("id", "centre")).distinct()


def _in_blocks(df: DataFrame, blocks: DataFrame, own: str) -> DataFrame:
    """Each row once for every pair of its bucket's blocks that has its own, in the tasks' order."""
    pairs = df.join(blocks, "band").withColumn("own", F.pmod(F.xxhash64(own), F.col("blocks")).cast("int"))
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "blocks")


def _rest(open_buckets: DataFrame, nodes: DataFrame, parts: int) -> DataFrame:
    """The partners left to compare: a node outside its bucket's largest component, a part of the nodes, those in it.

    Partners are nodes of other components whose signatures agree. Buckets are cut into blocks, and each block meets each
    other one in a group of its own. Of the buckets that two nodes share the first one compares them. A row holds all
    partners of a node in one of ``parts`` parts of all nodes.
    """
    blocks = unique_side(open_buckets, "band", F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = open_buckets.join(nodes, "id").select(
        "band",
        "id",
        "component",
        (F.col("component") == F.col("main")).alias("in_main"),
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"),
        "signature",
        "bands",
    )
    keys = ("band", "low", "high")
    columns = (*keys, "own", "id", "component", "in_main", "part", "signature", "bands")
    placed = _in_blocks(rows, blocks, "id").select(*columns).repartition(*keys).sortWithinPartitions(*keys, "id")

    def partners(some: list[tuple], same_block: bool) -> Iterator[tuple]:
        owns, ids, of, main, in_part = (np.array([row[k] for row in some]) for k in (3, 4, 5, 6, 7))
        all_signatures = np.frombuffer(b"".join([row[8] for row in some]), np.uint8).reshape(len(some), -1)
        bands, band = np.array([row[9] for row in some]), some[0][0]
        places = np.arange(len(some))
        for i in np.flatnonzero(~main).tolist():
            # Two nodes outside the largest component meet once.
            others = (of != of[i]) & (main | (places > i)) & (same_block | (owns != owns[i]))
            where = np.flatnonzero(others)
            where = where[(all_signatures[where] == all_signatures[i]).mean(axis=1) >= LEAST_ESTIMATE]
            shared = bands[where] == bands[i]
            where = where[bands[i][shared.argmax(axis=1)] == band]
            for k in np.unique(in_part[where]).tolist():
                yield int(ids[i]), k, ids[where[in_part[where] == k]].tolist()

    schema = pa.schema([("id", pa.int64()), ("part", pa.int32()), ("partners", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (batch.slice(at, 512) for batch in batches for at in range(0, batch.num_rows, 512))
        rows = (row for part in slices for row in zip(*[c.to_pylist() for c in part.columns], strict=True))
        for (_, low, high), some in groupby(rows, key=lambda row: row[:3]):
            found = list(partners(list(some), low == high))
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    lists = placed.mapInArrow(run, "id long, part int, partners array<long>")
    return lists


def _confirmed_lists(lists: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links among the lists of ``_rest``. The sets of a part of the nodes are held while its lists are gone through."""
    held = sets.join(nodes, "id", "left_semi").select(
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"),
        F.lit(0).alias("turn"),
        "id",
        "shingles",
        F.lit(None).cast("array<long>").alias("partners"),
    )
    asked = lists.join(sets, "id").select("part", F.lit(1).alias("turn"), "id", "shingles", "partners")
    placed = held.union(asked).repartition("part").sortWithinPartitions("part", "turn")

    def linked(rows: Iterator[tuple]) -> Iterator[tuple]:
        known: dict[int, np.ndarray] = {}
        for _, turn, node, raw, partners in rows:
            x = np.frombuffer(raw, np.uint64)
            if turn == 0:
                known[node] = x
                continue
            for other in partners:
                if similar(x, known[other], percent):
                    yield node, other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (batch.slice(at, 512) for batch in batches for at in range(0, batch.num_rows, 512))
        rows = (row for part in slices for row in zip(*[c.to_pylist() for c in part.columns], strict=True))
        for _, some in groupby(rows, key=lambda row: row[0]):
            found = list(linked(some))
            a, b = zip(*found, strict=True) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return placed.mapInArrow(run, "a long, b long")


def _of_one_id(features: DataFrame, of_digest: DataFrame) -> DataFrame:
    """Links between the nodes of ids that occur with several sets, from each to the smallest."""
    hashed = features.where("digest IS NOT NULL").select("id", "digest", F.xxhash64("digest").alias("hash"))
    several = unique_side(hashed, "id", F.min("hash").alias("low"), F.max("hash").alias("high")).where("low < high").select("id")
    found = hashed.join(several, "id").select("id", "digest").join(of_digest.select("digest", "node"), "digest").select("id", "node")
    least = unique_side(found, "id", F.min("node").alias("a"))
    return found.join(least, "id").where("a < node").select("a", F.col("node").alias("b")).distinct()


def _written(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: the documents' features; the node and smallest id of each digest; the components of the nodes.

    A node is a number that its digest gets when the table of digests is written, as ids may repeat with other texts.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    features = stored(_features(source, words), "features")
    of_digest = unique_side(features.where("digest IS NOT NULL"), "digest", F.min("id").alias("id"))
    of_digest = stored(of_digest.withColumn("node", F.monotonically_increasing_id()), "nodes")
    nodes = features.join(of_digest, ["id", "digest"]).select(F.col("node").alias("id"), "bands", "signature").dropDuplicates(["id"])
    nodes = stored(nodes, "signatures")
    buckets = nodes.select("id", F.explode("bands").alias("band"))
    signatures = nodes.select("id", "signature")

    ends = unique_side(buckets, "band", F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    # Only the buckets of several nodes are looked at again.
    members = stored(buckets.join(ends, "band"), "buckets")
    # So only their texts are read into sets again. Joined in the same way at every size.
    several = members.select(F.col("id").alias("node")).distinct().join(of_digest, "node").hint("merge")
    sets = _sets(source.join(several, "id", "left_semi"), words).join(several.select("digest", F.col("node").alias("id")), "digest")
    sets = stored(sets.select("id", "shingles"), "shingles")
    members, pairs = members.select("band", "id"), _to_ends(members)
    links = stored(_confirmed(stored(_similar(pairs, signatures), "pairs"), sets, percent).union(_of_one_id(features, of_digest)), "links")
    found = components(links)
    for k in range(ROUNDS):
        pairs = _to_centres(_open(members, found, k * CENTRES))
        links = stored(_confirmed(stored(_similar(pairs, signatures), "pairs"), sets, percent), "links")
        found = components(links.union(found.select("node", "component")))
    left = stored(_open(members, found, 0).select("band", "id", "component", "main"), "open")
    ids = left.select("id").distinct()
    parts = _parts(sets.join(ids, "id", "left_semi"))
    lists = stored(_rest(left, nodes, parts), "partners")
    links = stored(_confirmed_lists(lists, ids, sets, percent, parts), "links")
    found = components(links.union(found.select("node", "component")))
    return features, of_digest, found


def _parts(sets: DataFrame) -> int:
    """In how many parts the nodes of some sets are held in memory: by their number and by their bytes."""
    size = sets.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("shingles")), F.lit(0)).alias("bytes")).first()
    spread = min(sets.sparkSession.sparkContext.defaultParallelism, size.n // 256)
    return max(1 + size.n // BLOCK, 1 + size.bytes // BLOCK_BYTES, spread)


def mark_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` and ``kept``.

    A text's set holds its distinct shingles of ``words`` words, with A-Z in lower case; with fewer words, the whole
    sequence. Documents are linked when ``100 * intersection >= percent * union``, and ``component_id`` is the smallest id
    that links lead to. NULL, empty and blank texts have an empty set, are linked with nothing and are kept. Rows without
    an id are linked with nothing and kept, with a NULL ``component_id``. Rows that repeat an id with the same text give
    equal rows; with other texts the rows of one id count as linked. Ids are integers. Other columns are ignored.
    """
    with small_batches(docs.sparkSession, BATCH_ROWS):
        features, of_digest, found = _written(docs, id_col, text_col, words, percent)
    reps = of_digest.join(found, "node", "left").select("digest", "id", F.coalesce("component", "node").alias("component"))
    least = unique_side(reps, "component", F.min("id").alias("least"))
    reps = unique_side(reps.join(least, "component"), "digest", F.min("least").alias("component"))
    marked = features.where("digest IS NOT NULL").join(reps, "digest")
    alone = features.where("digest IS NULL").withColumn("component", F.col("id"))
    both = marked.select("id", "n_shingles", "component").union(alone.select("id", "n_shingles", "component"))
    return both.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows that ``mark_near_copies`` keeps, with the columns of the input."""
    marked = mark_near_copies(docs, id_col, text_col, words, percent)
    dropped = marked.where("NOT kept").select(F.col(id_col).alias(id_col)).distinct()
    return docs.join(dropped, id_col, "left_anti").select(docs.columns)
