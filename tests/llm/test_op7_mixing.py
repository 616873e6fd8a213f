import hashlib
import math

import pytest

from compare import connect, differences
from sluicebox.llm import mixing, queries
from sluicebox.llm.mixing import interleave, mixture


def edf(counts):
    """Source of each slot, by earliest deadline among the released blocks; one slot after another."""
    slots, done, order = sum(counts), [0] * len(counts), []
    for t in range(slots):
        ready = [
            (math.ceil((done[i] + 1) * slots / n), i) for i, n in enumerate(counts) if done[i] < n and done[i] * slots // n <= t
        ]
        i = min(ready)[1]
        order.append((i, done[i]))
        done[i] += 1
    return order


def brute_force(rows, weights, other, block):
    """By id: group, block and slot. Rows are (id, source, characters)."""
    names, parts = list(weights), [*weights.values(), other]
    streams = {}
    for doc, source, chars in rows:
        streams.setdefault(names.index(source) if source in names else len(names), []).append((hashlib.md5(str(doc).encode()).hexdigest(), doc, chars + 1))
    of_doc, blocks = {}, {}
    for group, docs in streams.items():
        at = 0
        for _, doc, chars in sorted(docs):
            of_doc[doc] = (group, at // block)
            at += chars
        blocks[group] = math.ceil(at / block)
    slot_of, slot, frame = {}, 0, 0
    while any(parts[g] * frame < n for g, n in blocks.items()):
        groups = sorted(blocks)
        counts = [max(0, min(parts[g], blocks[g] - parts[g] * frame)) for g in groups]
        for i, nth in edf(counts):
            slot_of[groups[i], parts[groups[i]] * frame + nth] = slot
            slot += 1
        frame += 1
    return {doc: (names[g] if g < len(names) else None, b, slot_of[g, b]) for doc, (g, b) in of_doc.items()}


@pytest.mark.parametrize("counts", [[20, 10, 10, 5, 5, 50], [1, 1], [7], [33, 33, 34], [1, 99], [3, 5, 7, 11, 13]])
def test_each_source_stays_within_a_block_of_its_share(counts):
    order, total, done = edf(counts), sum(counts), [0] * len(counts)
    for t, (i, _) in enumerate(order, 1):
        done[i] += 1
        assert all(abs(d - n * t / total) < 1 for d, n in zip(done, counts, strict=True))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "source", "length(text) AS n").collect()
    volumes = {}
    for row in docs:
        if row.source not in mixing.WEIGHTS:
            volumes[row.source] = volumes.get(row.source, 0) + row.n + 1
    total = sum(volumes.values())
    parts = {source: max(1, math.floor(50 * n / total + 0.5)) for source, n in volumes.items() if source is not None}
    rest = max(1, math.floor(50 * volumes.get(None, 0) / total + 0.5))
    weights = mixing.WEIGHTS | dict(sorted(parts.items()))
    assert len(weights) == 20 and mixing.target_weights(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")) == (weights, rest)
    expected = brute_force([tuple(row) for row in docs], weights, rest, mixing.BLOCK_CHARS)
    found = {row.doc_id: (row.mix_group, row.block, row.slot) for row in queries.op7_pfair_mixing(spark, "/root/testdata/sf0.01").collect()}
    assert found == expected


def test_query_equals_sql(spark):
    assert differences(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", "op7_pfair_mixing") == []


def test_small_blocks_and_sources_that_end_early(spark):
    rows = [(i, f"s{i % 3 if i < 60 else 1}", "x" * (i * 37 % 90)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    weights = {"s0": 3, "s1": 1}
    expected = brute_force([(i, s, len(t)) for i, s, t in rows], weights, 2, 40)
    assert {row.doc_id: (row.mix_group, row.block, row.slot) for row in interleave(df, weights, 2, 40).collect()} == expected
    placed = {row.doc_id: row for row in interleave(df, weights, 2, 40).collect()}
    order = [row.doc_id for row in mixture(df, weights, 2, 40).collect()]
    assert order == sorted(order, key=lambda doc: (placed[doc].slot, placed[doc].start)) and sorted(order) == list(range(300))


def test_edges(spark):
    rows = [(None, None, None, "a"), (1, "src0", "", "b"), (1, "src0", "", "b"), (2, "src0", "x" * 100_000, "c"), (3, "none", "y", "d")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, slot string")
    found = interleave(df)
    assert found.columns == ["doc_id", "source", "text", "mix_group", "block", "slot", "start"] and found.count() == 5
    assert {row.slot for row in mixture(df).collect()} == set("abcd")
    assert interleave(df.limit(0)).collect() == [] and mixture(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        interleave(df, {"a": 0})


def test_no_python_and_no_text_in_the_shuffles(spark):
    found = queries.op7_pfair_mixing(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_source_of_the_query_stays_within_a_block_of_its_weight(spark):
    """In all frames that hold the blocks of every source."""
    path = "/root/testdata/sf0.1"
    weights, _ = mixing.target_weights(spark.read.parquet(f"{path}/documents.parquet"))
    rows = queries.op7_pfair_mixing(spark, path).select("mix_group", "block", "slot").distinct().collect()
    blocks = {}
    for row in rows:
        blocks[row.mix_group] = max(blocks.get(row.mix_group, 0), row.block + 1)
    assert blocks.keys() == weights.keys() and len(blocks) == 20
    total, frames = sum(weights.values()), min(n // weights[name] for name, n in blocks.items())
    full = [row for row in rows if row.slot < frames * total]
    assert frames >= 1 and len(full) > 50
    for name, block, slot in full:
        assert abs(block - weights[name] * slot / total) < 1 and abs(block + 1 - weights[name] * (slot + 1) / total) < 1


def test_sources_beyond_the_bound_share_one_weight(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    rows = [(i, f"t{i % 4}" if i % 9 else None, "x" * (20 * (i % 4))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    weights, rest = mixing.target_weights(df)
    assert set(weights) == {*mixing.WEIGHTS, "t2", "t3"} and rest >= 1 and weights["t3"] > weights["t2"]
    assert interleave(df).count() == 100
