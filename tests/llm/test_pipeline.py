import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sluicebox.llm import mixing
from sluicebox.llm.work import in_file_order, new_folder, stored
from test_op10_near_dedup import brute_force

SF_DIR = "/root/testdata/sf0.01"


def test_stages_keep_what_their_predecessors_kept(spark):
    """Each stage on its own input against a plain version, and the packed ids against the texts that are left."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {row.doc_id: row.asDict() for row in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        rows = docs.collect()
        left = {row.doc_id: row.asDict() for row in rows}
        assert len(left) == len(rows) and all(before[doc] == row for doc, row in left.items())
        if name == "toxicity":
            toxic = {row.doc_id for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
            gone = before.keys() - left.keys()
            assert len(gone & toxic) > 0.7 * len(toxic & before.keys()) and len(gone) < 0.12 * len(before)
        elif name == "exact_dedup":
            first = {}
            for doc in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[doc]["text"] or ""), doc)
            assert set(left) == set(first.values())
        elif name == "near_dedup":
            found = brute_force([(doc, row["text"]) for doc, row in before.items()], 5)
            assert set(left) == {doc for doc, (_, component) in found.items() if doc == component}
        else:
            assert left == before
        before = left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    ids = {}
    for piece in sorted(pieces, key=lambda piece: (piece.doc_id, piece.start)):
        assert piece.ids_crc32 == zlib.crc32(np.array(piece.ids, dtype="<u4").tobytes())
        ids.setdefault(piece.doc_id, []).extend(piece.ids)
    assert ids == {doc: tokenizer.encode(row["text"], add_special_tokens=False).ids + [1] for doc, row in before.items()}


def test_file_order_with_columns_of_clashing_names(spark):
    names = ["_metadata", "part", "file", "row", "row_", "id"]
    df = spark.range(60).select(*[F.lit(i).alias(name) for i, name in enumerate(names[:-1])], "id")
    path = new_folder(spark, "clash")
    df.repartition(4).sortWithinPartitions("id").write.parquet(path)
    ordered = in_file_order(spark.read.parquet(path))
    assert ordered.columns == names
    by_file = [row.id for file in sorted(spark.read.parquet(path).inputFiles()) for row in spark.read.parquet(file).collect()]
    assert [row.id for row in ordered.collect()] == by_file


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0


def test_sequences_follow_the_mixture_over_many_files(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    slots = {row.doc_id: (row.slot, row.start) for row in mixing.interleave(docs).select("doc_id", "slot", "start").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = stored(corpus_pipeline.mixed(spark, docs, SF_DIR), "mixing")
        pieces = corpus_pipeline.packed(spark, mixed, SF_DIR).where("sequence_class > 0 AND NOT filler").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(mixed.inputFiles()) > 3 and len({piece.sequence_id >> 40 for piece in pieces}) > 3
    # Sequences of one class take their pieces in the order in which documents come.
    for k in {piece.sequence_class for piece in pieces}:
        same = sorted((piece.sequence_id, piece.offset, slots[piece.doc_id]) for piece in pieces if piece.sequence_class == k)
        assert [slot for *_, slot in same] == sorted(slot for *_, slot in same)
