"""SHA-256 of ordered lists of values, however long a list is."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Values that one row of the second step holds at most.
CHUNK = 256


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _filled(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) == 1024:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in some], schema=schema)
            some = []
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in some], schema=schema)


def joined_sha256(rows: DataFrame, value: str = "value", name: str = "sha256") -> DataFrame:
    """``key`` and the lower-case hex SHA-256 of its values as text, in their order and joined by commas.

    ``rows`` has a text ``key`` and ``value``; a key without rows is not in the result, NULLs are not allowed. The rows
    are sorted over all tasks and put together there in pieces of CHUNK values, so that the one task a long list has to
    go through, as its hash is a chain, reads a row for each piece and holds one at a time.
    """
    parts = rows.select("key", value).repartitionByRange("key", value).sortWithinPartitions("key", value)
    part_schema = pa.schema([("key", pa.string()), ("part", pa.int32()), ("nth", pa.int64()), ("text", pa.string())])

    def pieces(found: Iterator[tuple], part: int) -> Iterator[tuple]:
        for key, some in groupby(found, key=lambda row: row[0]):
            held, nth = [], 0
            for _, x in some:
                held.append(str(x))
                if len(held) == CHUNK:
                    yield key, part, nth, ",".join(held)
                    held, nth = [], nth + 1
            if held:
                yield key, part, nth, ",".join(held)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _filled(pieces(_rows(batches), TaskContext.get().partitionId()), part_schema)

    cuts = parts.mapInArrow(cut, "key string, part int, nth long, text string")
    schema = pa.schema([("key", pa.string()), (name, pa.string())])

    def digests(found: Iterator[tuple]) -> Iterator[tuple]:
        for key, some in groupby(found, key=lambda row: row[0]):
            digest, between = hashlib.sha256(), b""
            for *_, text in some:
                digest.update(between + text.encode())
                between = b","
            yield key, digest.hexdigest()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _filled(digests(_rows(batches)), schema)

    # A sort merges by the numbers of the tasks above, which follow the order of the values.
    return cuts.repartition(F.col("key")).sortWithinPartitions("key", "part", "nth").mapInArrow(hashed, f"key string, {name} string")
