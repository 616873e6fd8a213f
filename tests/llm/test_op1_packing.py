import itertools
import string
import sys
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluicebox.llm import packing, queries
from sluicebox.llm.packing import Bins, WordTokenizer, _batch, _by_bytes, _packed, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.01"


def check(pieces, docs):
    """Every id of every document in one piece, sequences without gaps, padded only where it is not a power of two."""
    tokenizer = Tokenizer.from_file(PATH)
    by_doc = {}
    for piece in pieces:
        by_doc.setdefault(piece.doc_id, []).append(piece)
    assert set(by_doc) == {doc for doc, _ in docs}
    for doc, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        at = 0
        for piece in sorted(by_doc[doc], key=lambda piece: piece.start):
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    sequences = {}
    for piece in pieces:
        sequences.setdefault(piece.sequence_id, []).append(piece)
    for some in sequences.values():
        at = 0
        for piece in sorted(some, key=lambda piece: piece.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= 2048 and at & (at - 1) == 0
        assert {piece.sequence_length for piece in some} == {at}
        (k,) = {piece.sequence_class for piece in some}
        of_class = [piece for piece in sorted(some, key=lambda piece: piece.offset) if not piece.filler]
        if k:
            # As many as the class says, in its range of lengths, and then what fills up the sequence.
            assert at == 2048 and len(of_class) == k and of_class[-1].offset + of_class[-1].length <= min([2048, *[x.offset for x in some if x.filler]])
            assert all(2048 // (k + 1) < piece.length <= 2048 // k for piece in of_class)
    return sequences


def test_query_packs_every_document_whole(spark):
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    pieces = queries.op1_harmonic_packing(spark, SF_DIR).collect()
    sequences = check(pieces, docs)
    # Most are full even of a small table; the others have no padding either.
    full = [some for some in sequences.values() if some[0].sequence_length == 2048]
    assert len(full) > 0.66 * len(sequences) and len({some[0].sequence_class for some in full}) > 10
    assert len(pieces) < 3 * len(docs) + sum(piece.length == 2048 for piece in pieces)


def ids_of(doc, tokens):
    return np.arange(doc * 100, doc * 100 + tokens, dtype="<u4").tobytes()


def test_classes_fillers_and_what_is_left():
    bins = Bins(16, 100)
    placed = [row for doc, tokens in enumerate([20, 5, 7, 6, 5, 5, 3, 6, 9]) for row in bins.add(doc, ids_of(doc, tokens))]
    lengths = [(piece[0], piece[1], len(piece[2]) // 4, *place) for piece, *place in placed]
    assert lengths == [
        (0, 0, 16, 100, 0, 16, 1, False),  # a whole sequence of a document of 20
        (2, 0, 7, 101, 0, 16, 2, False), (3, 0, 6, 101, 7, 16, 2, False), (4, 0, 3, 101, 13, 16, 2, True),
    ]
    left = [(piece[0], piece[1], len(piece[2]) // 4, *place) for piece, *place in bins.finish()]
    assert sum(row[2] for row in [*lengths, *left]) == 66 and all(row[6:] == (0, False) for row in left)
    assert [row[5] for row in left if row[4] == 0] == [16, 16, 2]  # of 34 ids
    got = {}
    for piece, *_ in sorted([*placed], key=lambda row: row[0][:2]):
        got[piece[0]] = got.get(piece[0], b"") + piece[2]
    assert got[3] == ids_of(3, 6) and got[2] == ids_of(2, 7)


@pytest.mark.parametrize("seed", range(3))
def test_every_id_is_placed_once_whatever_the_lengths(seed):
    draw = np.random.default_rng(seed)
    bins, docs = Bins(64, 0), [ids_of(k, n) for k, n in enumerate(draw.integers(1, 200, 300).tolist() + [64, 1, 128])]
    placed = [row for k, ids in enumerate(docs) for row in bins.add(k, ids)]
    placed += list(bins.finish())
    assert [row[1] for row in bins.finish()] == []
    for k, ids in enumerate(docs):
        assert b"".join(piece[2] for piece, *_ in sorted((row for row in placed if row[0][0] == k), key=lambda row: row[0][1])) == ids
    sizes = {sequence: length for _, sequence, _, length, *_ in placed}
    assert sum(sizes.values()) * 4 == sum(map(len, docs)) and all(n == 64 or n & (n - 1) == 0 for n in sizes.values())
    assert sum(n < 64 for n in sizes.values()) <= 6


def test_words_are_tokenised_as_the_whole_text():
    tokenizer, words = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    texts = ["", " ", "Don't STOP, it's 3½ café™", "a<|endoftext|>b", "İstanbul ΣΑΣ", "x​y\x1cz w", "中文 and 🎉!", "é́ ́a", "'s'S're"]
    for text in texts * 2:
        assert next(words.encode([text])) == _packed(tokenizer.encode(text, add_special_tokens=False).ids)


def test_words_that_return_after_others(monkeypatch):
    """Words and parts of words that are in the newer, in the older or in no store any more."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 12)
    tokenizer, words = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    draw = np.random.default_rng(1)
    some = ["word", "Word,", "WORD", "word's", "don't", "a1b2", "...", "x;y", "a<|endoftext|>b", "<|", "Ünder!", "中文", *(f"n{k}" for k in range(20))]
    for _ in range(200):
        texts = [" ".join(draw.choice(some, 4)) for _ in range(3)]
        assert list(words.encode(texts)) == [_packed(tokenizer.encode(text, add_special_tokens=False).ids) for text in texts]
        assert len(words.words) <= 12 + 40 and len(words.older) <= 12 + 40


def test_words_differ_by_letters_alone(monkeypatch):
    """Capitals and a sign behind don't make another word, and texts encoded together look a word up once."""
    tokenizer, words = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    texts = ["Word, word. WORD; Été?\nword: été! word", "wORD, wORd! ÉTÉ, word, a.", "", "a, word.b word,, word"]
    looked_up = []
    monkeypatch.setattr(words, "_ids_of", lambda new, own=words._ids_of: looked_up.extend(new) or own(new))
    assert list(words.encode(pa.array(texts))) == [_packed(tokenizer.encode(text, add_special_tokens=False).ids) for text in texts]
    assert set(words.words) - {""} == {"word", "été", "a", "a.", "b", *",.;?:!", "word.b", "word,,", ",,"}
    assert len(looked_up) == len(set(looked_up))


def test_every_sign_of_texts_tokenised_by_words():
    """Each with letters, capitals, digits and signs around it."""
    tokenizer, words = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    signs = [chr(k) for k in [*range(0x250), *range(0x2000, 0x20D0)]]
    for around in ("{}", "a{}b", "a{} b", "{}A, {}. {}b;", "1{}2", "it{}s, {}'S", "a,{}", ".{}. x", "<{}|"):
        texts = [around.replace("{}", sign) for sign in signs]
        for text, ids in zip(texts, words.encode(texts), strict=True):
            assert ids == _packed(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_slices_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "ENCODED_BYTES", 10)
    texts = ["long" * 10, None, "", "éé", "éé", "abc", None, "x" * 9, "x", "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(11)), pa.array([*texts, "z"])], names=["doc_id", "text"])
    parts = [part.column(1).to_pylist() for part in _by_bytes(batch.slice(0, 10))]
    assert parts == [texts[:1], texts[1:6], texts[6:8], texts[8:]]
    assert sum(parts, []) == texts and [part.num_rows for part in _by_bytes(batch.slice(0, 0))] == [0]


def test_memory_of_many_distinct_words():
    words = WordTokenizer(PATH)
    distinct = ("".join(letters) for letters in itertools.product(string.ascii_lowercase, repeat=5))
    for _ in range(24):
        text = " ".join(itertools.islice(distinct, 25_000))
        assert len(list(words.encode([text]))) == 1
    stores = [x for x in vars(words).values() if isinstance(x, dict)]
    held = {id(x): sys.getsizeof(x) for store in stores for x in (store, *store.keys(), *store.values())}
    assert sum(held.values()) < 100e6


def test_memory_of_ids_sent_on():
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    rows = [(k, np.arange(k, k + 2048, dtype="<u4").tobytes()) for k in range(1000)] + [(1000, b"")]
    tracemalloc.start()
    batch = _batch(rows, schema)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * 4 * 2048 * 1000
    assert batch.schema == schema and batch.column(0).to_pylist() == list(range(1001))
    assert [batch.column(1)[k].as_py() for k in (0, 999, 1000)] == [list(range(2048)), list(range(999, 999 + 2048)), []]
    assert _batch([], schema).num_rows == 0


def test_edges(spark):
    long = "word " * 30_000
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, long, "x"), (4, "twice", "y"), (None, "no id", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    pieces = pack(df, PATH, with_ids=True).collect()
    assert sorted((p.doc_id or 0, p.doc_tokens) for p in pieces if p.start == 0) == [(0, 3), (1, 1), (2, 1), (3, 1), (4, 2), (4, 30_001)]
    assert [p.ids for p in pieces if p.doc_id == 2] == [[1]]
    assert all(len(p.ids) == p.length for p in pieces)
    empty = pack(df.limit(0), PATH)
    assert empty.collect() == [] and empty.columns[0] == "doc_id"
    with pytest.raises(ValueError):
        pack(df, PATH, capacity=1000)
