import hashlib
import re

import pytest

from compare import connect, differences
from sluicebox.llm import exact_dedup
from sluicebox.llm.exact_dedup import drop_copies, mark_copies


def test_query_equals_sql(spark):
    con = connect("/root/testdata/sf0.01")
    assert differences(spark, con, "/root/testdata/sf0.01", "op9_exact_dedup") == []
    con.close()


@pytest.mark.parametrize("whole_group", [1, 64])
def test_against_brute_force(spark, monkeypatch, whole_group):
    """Also where every group of copies is cut over the partitions."""
    monkeypatch.setattr(exact_dedup, "WHOLE_GROUP", whole_group)
    texts = ["a  b", "a b", "a\tb", "a b ", "", None, " ", "A b", "a b", "x" * 100_000, "x" * 100_000 + "y", "\n\x0b", "é", "é"]
    rows = [(i * 7 % 501, texts[i % 14] if i % 3 else "hot  text") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    expected = {
        doc: (min(docs), len(docs), doc == min(docs), hashlib.sha256(text.encode()).hexdigest())
        for text, docs in groups.items()
        for doc in docs
    }
    found = {row.doc_id: (row.keep_id, row.group_size, row.kept, row.text_sha256) for row in mark_copies(df).collect()}
    assert found == expected
    assert sorted(row.doc_id for row in drop_copies(df).collect()) == sorted(min(docs) for docs in groups.values())


def test_edges(spark):
    rows = [(None, "a", 1), (3, "a", 2), (3, "a", 2), (5, "a", 4), (None, "b", 5), (None, "b", 6), (9, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    marked = mark_copies(df)
    assert marked.columns == ["doc_id", "text", "keep_id", "group_size", "kept", "text_sha256"]
    kept = sorted((row.doc_id or 0, row.text or "", row.kept) for row in drop_copies(df).collect())
    assert [row[:2] for row in kept] == [(0, "b"), (3, "a"), (9, "")] and kept[1][2] == 2
    assert marked.where("text = 'a'").select("keep_id", "group_size").distinct().collect() == [(3, 4)]
    assert mark_copies(df.limit(0)).collect() == []
    named = df.withColumnsRenamed({"doc_id": "weird.id", "text": "the text"})
    assert drop_copies(named, "weird.id", "the text").count() == 3


def test_texts_are_shuffled_once_and_without_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mark_copies(df.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Window [") == 1
