"""WARC archives: pages written as response and revisit records, and read back from segments.

A long record is written in segments: a first record and continuation records. Reading brings the segments of a record
together by the identifier of its first one, in the order of their numbers, checks the total length, and takes the
payload out of its chunked transfer framing. Records in one piece are decoded where they are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sluicebox.llm.work import stored
from sluicebox.operators.skew import unique_side

VERSION = b"WARC/1.1"
# Bytes of a record's block in one segment, and of a chunk of a payload.
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
# Payloads of at least so many bytes are written once; later copies are revisits.
LEAST_REVISIT_BYTES = 0
# Records of an archive file, which bounds what a reader holds.
FILE_RECORDS = 20_000
# Equal rows that one task writes the records of.
REPEATS = 1_000
# Different repeated rows whose keys, of 40 bytes, are sent to all executors; more of them are joined by a shuffle.
MOST_BROADCAST = 100_000
DATE = "2024-01-01T00:00:00Z"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_CHUNKED = re.compile(rb"^transfer-encoding:\s*chunked\s*$", re.IGNORECASE | re.MULTILINE)
_RECORD_ID = re.compile(r"<urn:page:(-?\d+|none):[0-9a-f]+(?::[0-9a-f]+-\d+)?>")

# A part of a record as parsed. Records in one piece come decoded, without a block.
_PARTS = """key string, segment long, total long, type string, refers_to string, digest string, block binary,
    payload_bytes long, found_digest string, error string, payload binary"""
_RECORDS = """record_id string, record_type string, refers_to_record string, payload_digest string, payload_bytes long,
    error string, payload binary"""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    chunks = [payload[at : at + size] for at in range(0, len(payload), size)]
    return b"".join([b"%x\r\n%s\r\n" % (len(chunk), chunk) for chunk in chunks]) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload in a chunked body; extensions and trailers are ignored."""
    found, at = [], 0
    while True:
        line_end = body.index(b"\r\n", at)
        size = int(body[at:line_end].split(b";")[0], 16)
        at = line_end + 2
        if size == 0:
            return b"".join(found)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk has another length than stated")
        found.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if _CHUNKED.search(head.replace(b"\r\n", b"\n")) else body


def _record(block: bytes, **headers: str | int | None) -> bytes:
    """A record without the last of the two line ends that follow it; the text writer adds that."""
    lines = [f"{name.replace('_', '-')}: {value}" for name, value in headers.items() if value is not None]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    return VERSION + b"\r\n" + head + b"\r\n\r\n" + block + b"\r\n"


def _records_of(
    page: int | None, url: str | None, payload: bytes, origin: int | None, segment_bytes: int, chunk_bytes: int, own: str = ""
) -> Iterator[bytes]:
    """The records of a page. ``origin`` is the page whose payload a revisit refers to.

    ``own`` tells the record from others of the same page and payload; the one that others refer to has none.
    """
    hexed = hashlib.sha1(payload).hexdigest()
    name = f"{'none' if page is None else page}:{hexed}{own}"
    common = {
        "WARC_Record_ID": f"<urn:page:{name}>",
        "WARC_Date": DATE,
        "WARC_Target_URI": None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC_Payload_Digest": f"sha1:{digest(payload)}",
        "Content_Type": "application/http;msgtype=response",
    }
    if origin is not None:
        extra = {"WARC_Refers_To": f"<urn:page:{origin}:{hexed}>", "WARC_Profile": _PROFILE}
        yield _record(_HTTP_HEAD, WARC_Type="revisit", **common, **extra)
        return
    block = _HTTP_HEAD + chunked(payload, chunk_bytes)
    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(pieces) == 1:
        yield _record(block, WARC_Type="response", **common)
        return
    yield _record(pieces[0], WARC_Type="response", **common, WARC_Segment_Number=1)
    for number, piece in enumerate(pieces[1:], 2):
        yield _record(
            piece,
            WARC_Type="continuation",
            WARC_Record_ID=f"<urn:page-segment:{name}:{number}>",
            WARC_Date=DATE,
            WARC_Segment_Origin_ID=common["WARC_Record_ID"],
            WARC_Segment_Number=number,
            WARC_Segment_Total_Length=len(block) if number == len(pieces) else None,
        )


def _arrow_map(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]], schema: str, rows: int) -> DataFrame:
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


def write_archives(
    pages: DataFrame,
    path: str,
    least_revisit_bytes: int = LEAST_REVISIT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write a record per row into gzipped archive files below ``path``.

    The payload is the text in UTF-8, NULL being empty. Of rows with equal payloads of ``least_revisit_bytes`` or more,
    the one with the largest id is a response and the others are revisits of it; a row without an id is a response. Of
    rows that repeat both id and payload one is the response, that of the last url, and the others are revisits too: a
    record for each row. Other columns are ignored.

    Rows that are equal altogether travel as one with their number, and are dealt out again REPEATS at a time.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    rows = rows.withColumn("same", F.md5(F.to_json(F.struct("page", "url", "sha"))))
    repeated = stored(unique_side(rows, "same", F.count("*").alias("times")).where("times > 1"), "repeated")
    if repeated.count() <= MOST_BROADCAST:  # so that no payload is shuffled for the sake of few rows
        repeated = F.broadcast(repeated)
    once = rows.join(repeated, "same", "left_anti").withColumns({"first": F.lit(0).cast("long"), "times": F.lit(1).cast("long")})
    some = rows.join(repeated, "same", "left_semi").groupBy("same", "page", "url", "sha").agg(F.first("payload").alias("payload"), F.count("*").alias("total"))
    some = some.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(REPEATS).cast("long"))))
    some = some.withColumn("times", F.least(F.lit(REPEATS), F.col("total") - F.col("first"))).repartition("same", "first")
    rows = once.unionByName(some.drop("total"))

    # Of each payload that several rows have: the largest page, and of its urls the last.
    last = F.max(F.struct("page", F.col("url").isNotNull().alias("named"), F.coalesce("url", F.lit("")).alias("url"))).alias("last")
    large = rows.where((F.octet_length("payload") >= least_revisit_bytes) & F.col("page").isNotNull())
    copied = unique_side(large, "sha", last, F.sum("times").alias("n")).where("n > 1")
    rows = rows.join(copied.select("sha", "last"), "sha", "left")
    is_last = (F.col("page") == F.col("last.page")) & (F.col("url").isNotNull() == F.col("last.named")) & (F.coalesce("url", F.lit("")) == F.col("last.url"))
    rows = rows.select("page", "url", "payload", F.col("last.page").alias("origin"), F.coalesce(is_last, F.lit(False)).alias("is_last"), "first", "times")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for page, url, payload, origin, is_last, first, times in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True):
                    origin = None if page is None else origin
                    of_url = hashlib.md5(repr(url).encode("utf-8", "surrogatepass")).hexdigest()[:16]
                    for nth in range(first, first + times):
                        is_origin = is_last and nth == 0
                        own = "" if is_origin else f":{of_url}-{nth}"
                        for record in _records_of(page, url, payload, None if is_origin else origin, segment_bytes, chunk_bytes, own):
                            yield (record,)

    lines = _arrow_map(rows, records, "record binary", 512).select(F.col("record").cast("string"))
    lines.write.options(lineSep="\r\n", compression="gzip", maxRecordsPerFile=FILE_RECORDS).text(path)


class _Reader:
    """Reads from chunks of bytes."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held, self.at = chunks, b"", 0

    def _more(self) -> bool:
        chunk = next(self.chunks, None)
        self.held, self.at = self.held[self.at :] + (chunk or b""), 0
        return chunk is not None

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next ``mark``, which is skipped; None at the end."""
        while (end := self.held.find(mark, self.at)) < 0:
            if not self._more():
                return None
        found, self.at = self.held[self.at : end], end + len(mark)
        return found

    def exactly(self, size: int) -> bytes:
        while len(self.held) - self.at < size:
            if not self._more():
                raise ValueError("an archive ends within a record")
        found, self.at = self.held[self.at : self.at + size], self.at + size
        return found


def _inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of all gzip members; of a file without compression, the file's."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        member = zlib.decompressobj(31)
        while not member.eof:
            out = member.decompress(content, 1 << 20)
            content = member.unconsumed_tail
            yield out
            if not out and not content and not member.eof:
                raise ValueError("an archive ends within a gzip member")
        content = member.unused_data


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with names in lower case, and block of each record of an archive file."""
    reader = _Reader(_inflated(content))
    while (head := reader.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("an archive has something else than a record")
        headers = {}
        for line in lines:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        block = reader.exactly(int(headers["content-length"]))
        if reader.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record has another length than stated")
        yield headers, block


def _decoded(block: bytes, stated: str | None, with_payload: bool) -> tuple:
    """Payload bytes, digest, error and payload of a whole block."""
    try:
        payload = payload_of(block)
    except ValueError as error:
        return None, None, f"framing: {error}", None
    found = digest(payload)
    error = None if stated in (None, found) else "the payload has another digest than stated"
    return len(payload), found, error, payload if with_payload else None


def _assembled(key: str, parts: list[tuple], with_payload: bool) -> tuple:
    """A record from its parts in the order of their numbers; copies of a part count once."""
    _, _, _, kind, refers_to, stated, block, size, found, error, payload = parts[0]
    if block is not None:
        blocks = {part[1]: part[6] for part in parts}
        total = next((part[2] for part in reversed(parts) if part[2] is not None), None)
        if kind == "continuation" or sorted(blocks) != list(range(1, len(blocks) + 1)):
            error = "a segment is missing"
        elif total != sum(map(len, blocks.values())):
            error = "the segments have another length than stated"
        else:
            size, found, error, payload = _decoded(b"".join(blocks.values()), stated, with_payload)
    return key, kind, refers_to, found or stated, size, error, payload


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The response and revisit records of all archive files below ``path``.

    ``error`` says what is wrong with a record, such as a missing segment; a broken file fails the job. A revisit has
    the digest it states and no size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                for headers, block in parse(batch.column(0)[i].as_py()):
                    kind, record_id = headers.get("warc-type"), headers.get("warc-record-id")
                    stated = headers.get("warc-payload-digest", "sha1:").removeprefix("sha1:") or None
                    number, total = headers.get("warc-segment-number"), headers.get("warc-segment-total-length")
                    if kind == "revisit":
                        yield record_id, 1, None, kind, headers.get("warc-refers-to"), stated, *[None] * 5
                    elif kind == "continuation":
                        origin = headers.get("warc-segment-origin-id")
                        yield origin, int(number), int(total) if total else None, kind, None, None, block, *[None] * 4
                    elif kind == "response" and number:
                        yield record_id, int(number), None, kind, None, stated, block, *[None] * 4
                    elif kind == "response":
                        yield record_id, 1, None, kind, None, stated, None, *_decoded(block, stated, with_payload)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                for part in zip(*[c.to_pylist() for c in batch.slice(at, 128).columns], strict=True):
                    if held and held[0][0] != part[0]:
                        yield _assembled(held[0][0], held, with_payload)
                        held = []
                    held.append(part)
        if held:
            yield _assembled(held[0][0], held, with_payload)

    found = _arrow_map(files, parts, _PARTS, 256)
    # A record's parts are neighbours, so that one record is held at a time.
    found = found.repartition("key").sortWithinPartitions("key", "segment")
    return _arrow_map(found, records, _RECORDS, 256)


def _page_of(record: str) -> Column:
    return F.regexp_extract(F.col(record), _RECORD_ID.pattern, 1).try_cast("long")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per page of archives made by ``write_archives``: id, size and digest of the full payload, type, origin.

    The size of a revisit is that of the response it refers to, which must have the same digest.
    """
    records = stored(read_archives(spark, path).drop("payload"), "records")
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("origin_digest")
    )
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(responses, "refers_to_record", "left")
    wrong = F.when(F.col("origin_digest").eqNullSafe(F.col("payload_digest")), F.lit(None).cast("string"))
    revisits = revisits.select(
        "record_id",
        "record_type",
        "refers_to_record",
        "payload_digest",
        F.col("size").alias("payload_bytes"),
        wrong.otherwise("the response it refers to is missing or differs").alias("error"),
    )
    both = records.where("record_type <> 'revisit'").select(revisits.columns).union(revisits)
    return both.select(
        _page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        _page_of("refers_to_record").alias("refers_to"),
        "error",
    )
