"""Documents cut and packed into training sequences by harmonic classes.

Class ``k`` holds lengths above ``capacity / (k + 1)`` and up to ``capacity / k``, and its sequences take exactly ``k`` of
them. A document fills whole sequences first; what remains of it goes into its class in one piece. The room that a closed
sequence has left is filled by the documents that come next, which are the only ones cut, so full sequences have no
padding. Every task fills its own sequences and only keeps the pieces of the one open sequence of each class, so nothing
is shuffled. What is left open at the end of a task is put together to full sequences and the last of it cut into powers
of two, which need no padding either.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 2048
END_ID = 1
# Words and parts of words whose ids a worker keeps twice over: when the store has so many, the older one is dropped. It stays
# with the worker for later tasks, those of other stages too.
CACHED_WORDS = 300_000
# Bytes of texts that are tokenised together: the more, the more often a word is one that the same texts have already.
ENCODED_BYTES = 2 << 20
# Parts of words that the tokenizer gets at a time.
ENCODED_PARTS = 4096
# Ids and pieces that are sent on at a time.
SENT_IDS, SENT_PIECES = 1 << 20, 4096
# Texts of other characters, or with what may be a special token, go through the tokenizer as a whole. The lower case of all
# the rest is that of each character alone, nothing in them composes, and their white space is the tokenizer's, so they
# can be tokenised word by word.
_OTHER = (
    r"[^\t\n\r\x20-\x7e\x{a0}-\x{12f}\x{131}-\x{17f}\x{2010}-\x{2027}\x{2030}-\x{205e}\x{20a0}-\x{20bf}]|<\|"
)
# One sign between a letter and white space is a part of its own; set apart, it leaves fewer distinct words.
_SIGN_BEHIND = (r"(\pL)([,.!?;:])([ \n])", r"\1 \2\3")
# Sequence numbers of a task start at its partition number times this.
_PER_TASK = 1 << 40


class WordTokenizer:
    """Token ids of a text as little-endian unsigned 32-bit numbers; words seen lately are not encoded again."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for parts of words, which are split and in lower case already.
        self.of_parts = Tokenizer(self.tokenizer.model)
        self.of_parts.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # The tokenizer's own split into words; it drops white space and puts no token across two of them.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # A part of a word is a word too, so both are in one store.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _add_parts(self, new: list[str]) -> None:
        """Encode distinct parts together, and cut the ids where a token ends a part."""
        lines = [new[at : at + 64] for at in range(0, len(new), 64)]
        encoded = self.of_parts.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False)
        for line, found in zip(lines, encoded, strict=True):
            ids = np.array(found.ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) != len(line) or ends[-1] != ids.nbytes:
                self.words.update((part, self._whole(part)) for part in line)
                continue
            raw, start = ids.tobytes(), 0
            for part, end in zip(line, ends.tolist(), strict=True):
                self.words[part] = raw[start:end]
                start = end

    def _add_words(self, words: list[str]) -> None:
        known, older, split = self.words, self.older, []
        parts = {word for word in words if word not in older}
        known.update((word, older[word]) for word in words if word in older)
        for word in [word for word in parts if not word.isalpha()]:
            some = self.split.findall(word)
            if some != [word]:
                split.append((word, some))
                parts.discard(word)
        for part in {part for _, some in split for part in some}.difference(known):
            if (ids := older.get(part)) is not None:
                known[part] = ids
            else:
                parts.add(part)
        new = list(parts)
        for at in range(0, len(new), ENCODED_PARTS):
            self._add_parts(new[at : at + ENCODED_PARTS])
        for word, some in split:
            known[word] = b"".join([known[part] for part in some])

    def _ids_of(self, words: list[str]) -> list[bytes]:
        if len(self.words) > CACHED_WORDS:
            # Before adding, so that no word of these texts can be missing.
            self.words, self.older = {}, self.words
        known = self.words
        new = [word for word in words if word not in known]
        if new:
            self._add_words(new)
        return list(map(known.__getitem__, words))

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """Each distinct word of these texts is looked up once; the ids are put together by their places."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        other = pc.match_substring_regex(texts, _OTHER)
        plain = pc.utf8_lower(pc.if_else(other, "", texts))
        words = pc.utf8_split_whitespace(pc.replace_substring_regex(plain, *_SIGN_BEHIND))
        places = words.flatten().dictionary_encode()
        found = self._ids_of(places.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        every, index = np.frombuffer(b"".join(found), dtype="<u4"), places.indices.to_numpy()
        counts = sizes[index]
        ends = np.concatenate([[0], np.cumsum(counts)])
        # A word's ids follow those of the word before it in the texts; in ``every`` they start elsewhere.
        at = np.repeat((np.cumsum(sizes) - sizes)[index] - ends[:-1], counts)
        at += np.arange(len(at))
        ids, bounds = every[at], ends[words.offsets.to_numpy()].tolist()
        for nth, whole in enumerate(other.to_pylist()):
            yield self._whole(texts[nth].as_py()) if whole else ids[bounds[nth] : bounds[nth + 1]].tobytes()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


@functools.cache
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


# A piece: document, the place of its first id, its ids as bytes, and how many ids the document has.
Piece = tuple[object, int, bytes, int]


def _cut(piece: Piece, tokens: int) -> tuple[Piece, Piece | None]:
    """The first ids of a piece, and the rest of it."""
    doc, start, ids, total = piece
    rest = ids[4 * tokens :]
    return (doc, start, ids[: 4 * tokens], total), (doc, start + tokens, rest, total) if rest else None


class Bins:
    """The open sequence of each class in one task, and the closed one that has room left, of which there is one at most."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[Piece]] = {}
        self.waiting: tuple[int, int, list[Piece], int] | None = None

    def _sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def _placed(self, sequence: int, k: int, pieces: list[Piece]) -> Iterator[tuple]:
        offset, length = 0, sum(len(piece[2]) // 4 for piece in pieces)
        for nth, piece in enumerate(pieces):
            yield piece, sequence, offset, length, k, nth >= k > 0
            offset += len(piece[2]) // 4

    def add(self, doc: object, ids: bytes) -> Iterator[tuple]:
        """Pieces with sequence, offset, the sequence's length and class, and whether the piece fills up a closed one."""
        total = len(ids) // 4
        rest = total - total % self.capacity
        for start in range(0, rest, self.capacity):
            yield from self._placed(self._sequence(), 1, [(doc, start, ids[4 * start : 4 * (start + self.capacity)], total)])
        if rest < total:
            yield from self._place((doc, rest, ids[4 * rest :], total))

    def _place(self, piece: Piece | None) -> Iterator[tuple]:
        if self.waiting:
            sequence, k, pieces, room = self.waiting
            part, piece = _cut(piece, room)
            pieces.append(part)
            room -= len(part[2]) // 4
            self.waiting = (sequence, k, pieces, room) if room else None
            if not room:
                yield from self._placed(sequence, k, pieces)
        if not piece:
            return
        k = self.capacity // (len(piece[2]) // 4)
        pieces = self.open.setdefault(k, [])
        pieces.append(piece)
        if len(pieces) == k:
            sequence, room = self._sequence(), self.capacity - sum(len(x[2]) // 4 for x in self.open.pop(k))
            if room:
                self.waiting = (sequence, k, pieces, room)
            else:
                yield from self._placed(sequence, k, pieces)

    def finish(self) -> Iterator[tuple]:
        """What is open, as full sequences and powers of two of class 0."""
        left = [piece for _, pieces in sorted(self.open.items()) for piece in pieces]
        if self.waiting:
            left = [*self.waiting[2], *left]
        self.open, self.waiting = {}, None
        tokens = sum(len(piece[2]) // 4 for piece in left)
        while tokens:
            size = self.capacity if tokens >= self.capacity else 1 << (tokens.bit_length() - 1)
            tokens -= size
            pieces = []
            while size:
                part, rest = _cut(left[0], size)
                left[:1] = [rest] if rest else []
                pieces.append(part)
                size -= len(part[2]) // 4
            yield from self._placed(self._sequence(), 0, pieces)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    ``start`` and ``length`` count ids of the document, whose ids are those of its text and ``end_id``. ``offset`` is the
    piece's place in its sequence of ``sequence_length`` ids, which is ``capacity`` or a smaller power of two. Every id
    lies in one piece and pieces cover a sequence without gaps. ``sequence_class`` is the class k of the sequence, whose
    first k pieces are of that class and all others ``filler``; it is 0 for what a task had left. ``with_ids`` adds the ids themselves. NULL texts are
    empty and empty texts have one piece, the ``end_id``. Repeated rows are packed as often as they occur, so pieces of
    two rows with one id cannot be told apart. Other columns are ignored. The tokenizer file is read by every worker.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    source = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, source.schema[0].dataType)])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"):
        schema.add(name, T.LongType())
    schema.add("sequence_class", T.LongType()).add("filler", T.BooleanType())
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))
    end = _packed([end_id])

    def rows(bins: Bins, batches: Iterator[pa.RecordBatch], tokenizer: WordTokenizer) -> Iterator[tuple]:
        for batch in batches:
            for part in _by_bytes(batch):
                for doc, ids in zip(part.column(0).to_pylist(), tokenizer.encode(part.column(1).fill_null("")), strict=True):
                    yield from bins.add(doc, ids + end)
        yield from bins.finish()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, TaskContext.get().partitionId() * _PER_TASK)
        out: list[tuple] = []
        held = 0
        for (doc, start, ids, total), *place in rows(bins, batches, _tokenizer(tokenizer_path)):
            out.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, *place, *([ids] if with_ids else [])))
            held += len(ids) // 4 if with_ids else 0
            if len(out) >= SENT_PIECES or held >= SENT_IDS:
                yield _batch(out, arrow)
                out, held = [], 0
        yield _batch(out, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return source.mapInArrow(packed, schema)


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of ids and texts in slices of about ``ENCODED_BYTES`` of text, a longer text at the end of one."""
    before = pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64)
    before = (np.cumsum(before) - before) // ENCODED_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as a batch; a list of ids is given as their bytes, so that no id becomes an object."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([_array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _array(values: list, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    offsets = np.cumsum([0, *(len(ids) // 4 for ids in values)]).astype(np.int32)
    ids = np.frombuffer(b"".join(values), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), type=kind)
