"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one node. In each pass the nodes are sorted by the concatenated signs of random projections, so that
similar ones tend to share a long prefix, and every node is compared with the next ``WINDOW`` ones and with all that
share its prefix, its cell. Cells are counted first: those of up to ``BLOCK`` nodes stay in one task, larger ones, where
many vectors have much the same direction, are compared whole in blocks. The links of all passes give the components.
Their members are then compared in blocks, for the links between nodes that no pass brought together.

Passes move the vectors in half precision. A cosine farther from the threshold than its rounding can reach is decided
on these; the others are decided in double precision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sluicebox.llm.components import components
from sluicebox.llm.work import stored
from sluicebox.operators.skew import unique_side

COSINE = 0.95
WINDOW = 128
# Chance that a pair at the threshold is in no cell, wherever the other vectors lie.
MISSED = 1e-4
# Passes in one shuffle.
PASSES_AT_ONCE = 6
BITS = 62
# Half precision moves a component by 2 ** -11 of it, and the cosine of two unit vectors by less than this.
HALF_ERROR = 0.002
BLOCK = 1024
CELL = ("pass", "size", "cell")


def prefix_for(nodes: int, window: int = WINDOW) -> int:
    """Signs that make a cell: so many that a window would hold one, were all cells equally full."""
    return min(BITS, ceil(max(0.0, log2(max(nodes, 1) / window))))


def passes_for(nodes: int, cosine: float = COSINE, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes after which a pair at the threshold is missed with a chance of ``missed``.

    Two nodes meet when they share a cell, as all nodes of a cell are compared.
    """
    met = (1 - acos(cosine) / pi) ** prefix_for(nodes, window)
    return 1 if met >= 1 - missed else ceil(log(missed) / log(1 - met))


def _arrow_map(df: DataFrame, function, schema: str, rows: int = 4096) -> DataFrame:
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [[] for _ in arrow]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for row in function(batches):
            found.append(row)
            if len(found) >= rows:
                yield batch_of(found)
                found = []
        yield batch_of(found)

    return df.mapInArrow(run, kind)


def _rows(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from zip(*[column.to_pylist() for column in batch.slice(at, size).columns], strict=True)


def unit(vector: list | None) -> np.ndarray | None:
    """The vector in length 1 and double precision; None if it links with nothing."""
    if not vector or None in vector:
        return None
    found = np.array(vector, dtype=np.float64)
    largest = np.abs(found).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    found /= largest  # so that neither huge nor tiny numbers leave the range when squared
    return found / np.sqrt(found @ found)


def _features(vectors: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for row_id, vector in _rows(batches):
            found = None if row_id is None else unit(vector)
            if found is None:
                yield row_id, None, None
            else:
                raw = found.tobytes()
                yield row_id, hashlib.blake2b(raw, digest_size=16).digest(), raw

    return _arrow_map(vectors, rows, "id long, digest binary, vector binary", 1024)


def _projected(nodes: DataFrame, passes: range) -> DataFrame:
    """Each node once for each pass, with the signs of its projections as a number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                all_nodes, raws = part.column(0).to_pylist(), part.column(1).to_pylist()
                for size in sorted({len(raw) for raw in raws}):
                    some = [i for i, raw in enumerate(raws) if len(raw) == size]
                    x = np.frombuffer(b"".join([raws[i] for i in some])).reshape(len(some), -1)
                    half = x.astype(np.float16)
                    for k in passes:
                        if (k, size) not in planes:
                            planes[k, size] = np.random.default_rng([k, size]).standard_normal((x.shape[1], BITS))
                        keys = ((x @ planes[k, size]) > 0) @ weights
                        for i, key, vector in zip(some, keys.tolist(), half, strict=True):
                            yield k, size, key, all_nodes[i], vector.tobytes()

    return _arrow_map(nodes.select("node", "vector"), rows, "pass int, size int, key long, node long, half binary", 2048)


class _Forest:
    """Tells which links join two trees that were apart."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _windows(sorted_nodes: DataFrame, cosine: float, window: int) -> DataFrame:
    """Links of neighbours that connect something new within the task, and the pairs that are too close to call.

    Neighbours are the next ``window`` nodes and those of the same cell, unless that is NULL.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        group, nodes, cells, x, forest = None, [], None, None, _Forest()

        def compare(known: int) -> Iterator[tuple]:
            for k in range(1, len(nodes)):
                at = np.arange(max(0, known - k), len(nodes) - k)
                if k > window:
                    at = at[(cells[at] == cells[at + k]) & (cells[at] >= 0)]
                    if not len(at):
                        break
                found = np.einsum("ij,ij->i", x[at], x[at + k])
                near = found >= cosine - HALF_ERROR
                for i, sure in zip(at[near].tolist(), (found[near] >= cosine + HALF_ERROR).tolist(), strict=True):
                    if not sure or forest.join(nodes[i], nodes[i + k]):
                        yield nodes[i], nodes[i + k], sure

        for key, some in groupby(_rows(batches), key=lambda row: row[:2]):
            if key != group:
                group, nodes, cells, x, forest = key, [], np.zeros(0, dtype=np.int64), None, _Forest()
            some = list(some)
            for at in range(0, len(some), 1024):
                part = some[at : at + 1024]
                new = np.frombuffer(b"".join([row[4] for row in part]), dtype=np.float16).reshape(len(part), -1).astype(np.float32)
                known = len(nodes)
                nodes = nodes + [row[3] for row in part]
                cells = np.append(cells, np.array([-1 if row[5] is None else row[5] for row in part], dtype=np.int64))
                x = new if x is None else np.concatenate([x, new])
                yield from compare(known)
                open_cell = int((cells == cells[-1]).sum()) if cells[-1] >= 0 else 0
                kept = max(window, open_cell)
                nodes, cells, x = nodes[-kept:], cells[-kept:], x[-kept:]

    return _arrow_map(sorted_nodes.select("pass", "size", "key", "node", "half", "cell"), rows, "a long, b long, sure boolean")


def _in_blocks(members: DataFrame, *group: str) -> DataFrame:
    """Members of a group dealt to its ``blocks``, next to one another for each two blocks."""
    dealt = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = (*group, "low", "high")
    pairs = pairs.select(*group, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "weight", "vector")
    return pairs.repartition(*keys).sortWithinPartitions(*keys, "own")


def _stars(linked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and columns of each group that links connect."""
    left = linked.any(axis=1)
    while left.any():
        rows = np.zeros(linked.shape[0], dtype=bool)
        columns = np.zeros(linked.shape[1], dtype=bool)
        new = np.flatnonzero(left)[:1]
        while len(new):
            rows[new] = True
            reached = linked[new].any(axis=0) & ~columns
            columns |= reached
            new = np.flatnonzero(linked[:, reached].any(axis=1) & ~rows)
        left &= ~rows
        yield np.flatnonzero(rows), np.flatnonzero(columns)


def _whole_cells(members: DataFrame, cosine: float) -> DataFrame:
    """Links that connect the same nodes as all links within the cells, from comparing these in blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (*_, low, high), some in groupby(_rows(batches), key=lambda row: row[:5]):
            sides: dict[int, tuple] = {}
            for own, part in groupby(some, key=lambda row: row[5]):
                part = list(part)
                sides[own] = [row[6] for row in part], np.frombuffer(b"".join([row[8] for row in part])).reshape(len(part), -1)
            if low not in sides or high not in sides:
                continue
            (nodes, x), (others, y) = sides[low], sides[high]
            linked = x @ y.T >= cosine
            if low == high:
                np.fill_diagonal(linked, True)  # so that a node's row and its column are in one group
            for left, right in _stars(linked):
                first = nodes[left[0]]
                for node in {nodes[i] for i in left.tolist()} | {others[i] for i in right.tolist()}:
                    if node != first:
                        yield first, node, True

    return _arrow_map(_in_blocks(members, *CELL), rows, "a long, b long, sure boolean")


def _sided(nodes: DataFrame, name: str, vector: str) -> DataFrame:
    return nodes.select(F.col("node").alias(name), F.col("vector").alias(vector))


def _verified(pairs: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for a, b, left, right in _rows(batches):
            if np.frombuffer(left) @ np.frombuffer(right) >= cosine:
                yield a, b

    found = pairs.distinct().join(_sided(nodes, "a", "left"), "a").join(_sided(nodes, "b", "right"), "b")
    return _arrow_map(found.select("a", "b", "left", "right"), rows, "a long, b long")


def _counts(members: DataFrame, cosine: float) -> DataFrame:
    """``node`` and the number of rows linked with it, from comparing the members of each component in blocks."""
    sizes = unique_side(members, "component", F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    pairs = _in_blocks(members.join(sizes, "component"), "component")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (_, low, high), some in groupby(_rows(batches), key=lambda row: row[:3]):
            sides: dict[int, tuple] = {}
            for own, part in groupby(some, key=lambda row: row[3]):
                part = list(part)
                vectors = np.frombuffer(b"".join([row[6] for row in part])).reshape(len(part), -1)
                sides[own] = [row[4] for row in part], np.array([row[5] for row in part]), vectors
            if low not in sides or high not in sides:
                continue
            (nodes, weights, x), (others, other_weights, y) = sides[low], sides[high]
            linked = x @ y.T >= cosine
            if low == high:
                np.fill_diagonal(linked, False)
                yield from zip(nodes, (linked @ weights).tolist(), strict=True)
            else:
                yield from zip(nodes, (linked @ other_weights).tolist(), strict=True)
                yield from zip(others, (weights @ linked).tolist(), strict=True)

    return _arrow_map(pairs, rows, "node long, linked long").groupBy("node").agg(F.sum("linked").alias("linked"))


def mark_near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, window: int = WINDOW
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept``.

    Vectors of one length are linked when their cosine is at least ``cosine``; ``component_id`` is the smallest id that
    links lead to. NULL, empty and zero vectors and those with NULL or non-finite components are linked with nothing.
    So are rows without an id, which have a NULL ``component_id``. Rows that repeat an id count as vectors of their own.
    Ids are integers. Other columns are ignored. The number of passes follows from the number of different vectors.
    """
    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>"))
    features = stored(_features(source), "vectors")
    valid = features.where("digest IS NOT NULL")
    nodes = valid.groupBy("digest").agg(
        F.min("id").alias("node"), F.count("*").cast("long").alias("weight"), F.any_value("vector").alias("vector")
    )
    # A node is a digest; where rows repeat an id with other vectors, nodes of one id count as one for their links.
    nodes = stored(nodes, "nodes")
    n_nodes = nodes.count()
    passes, rest = passes_for(n_nodes, cosine, window), BITS - prefix_for(n_nodes, window)
    links = None
    for first in range(0, passes, PASSES_AT_ONCE):
        projected = _projected(nodes, range(first, min(first + PASSES_AT_ONCE, passes))).withColumn("cell", F.shiftright("key", rest))
        keys = stored(projected.select(*CELL, "node"), "keys")
        large = keys.groupBy(*CELL).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
        large = stored(large.select(*CELL, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "cells")
        placed = projected.join(large, list(CELL), "left").withColumn("is_large", F.col("blocks").isNotNull())
        # Partitions may end within a large cell, but no other one is cut.
        placed = placed.withColumns(
            {
                "place": F.when(F.col("is_large"), F.col("key")).otherwise(F.shiftleft("cell", rest)),
                "place_node": F.when(F.col("is_large"), F.col("node")),
                "cell": F.when(~F.col("is_large"), F.col("cell")),
            }
        ).repartitionByRange("pass", "size", "place", "place_node")
        found = stored(_windows(placed.sortWithinPartitions("pass", "size", "key", "node"), cosine, window), "windows")
        links = found if links is None else links.union(found)
        if not large.isEmpty():
            members = keys.join(large, list(CELL)).join(nodes.select("node", "weight", "vector", F.octet_length("vector").alias("size")), ["node", "size"])
            links = links.union(stored(_whole_cells(members, cosine), "whole_cells"))
    unsure = _verified(links.where("NOT sure").select("a", "b"), nodes, cosine)
    found = stored(components(links.where("sure").select("a", "b").union(unsure)), "components")

    members = nodes.join(found, "node").select("component", "node", "weight", "vector")
    of_node = nodes.select("digest", "node", "weight").join(found, "node", "left").join(_counts(members, cosine), "node", "left")
    of_digest = unique_side(
        of_node,
        "digest",
        F.max(F.expr("coalesce(linked, 0L) + weight - 1")).alias("n_links"),
        F.min(F.expr("coalesce(component, node)")).alias("component_id"),
    )
    marked = valid.select("id", "digest").join(of_digest, "digest").select("id", "n_links", "component_id")
    alone = features.where("digest IS NULL").select("id", F.lit(0).cast("long"), F.col("id"))
    both = marked.union(alone)
    return both.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
