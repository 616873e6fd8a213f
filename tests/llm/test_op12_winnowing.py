import hashlib
import random
import re

import pytest

from compare import connect, differences
from sluicebox.llm import decontamination
from sluicebox.llm.decontamination import mark_contaminated

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(len(words), 10)
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(window) for window in windows}
    found = []
    for doc, text in docs:
        words, hit, by = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    by |= windows[tuple(words[i : i + size])]
        names = sorted(str(item) for item in by if item is not None)
        found.append((doc, len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=str)


def marked(spark, docs, items):
    docs = spark.createDataFrame([(*row, 3, "x") for row in docs], "doc_id long, text string, n_words int, digest string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(row) for row in mark_contaminated(docs, items).select(COLUMNS).collect()), key=str)


def test_equals_sql(spark):
    assert differences(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", "op12_winnowing") == []


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed, monkeypatch):
    """Few words, so that windows recur and overlap; short items, repeated ids and texts, NULLs, long texts in pieces."""
    monkeypatch.setattr(decontamination, "PIECE", 300)
    monkeypatch.setattr(decontamination, "RUN", 16)
    draw = random.Random(seed)

    def text(n, words=("a", "B", "é9", "x1", "a")):
        return "".join(draw.choice(words) + draw.choice([" ", "_", "\n", "-"]) for _ in range(n))

    shared = text(30)
    items = [(i, text(draw.choice([10, 14, 25]))) for i in range(12)] + [(i, shared + text(5)) for i in range(12, 30)]
    items += [(30, "zz a zz"), (30, "q q"), (31, "zz"), (None, "only here " * 6), (32, None), (33, " _ "), (1, text(12)), (34, "a b é9 x1 a a b a x1")]
    docs = [(i, text(draw.choice([0, 5, 40, 200]))) for i in range(30)] + [(i, text(9) + shared + text(9)) for i in range(30, 50)]
    docs += [(60, "zz"), (61, "Q q zz a zz"), (62, "only here " * 6), (63, None), (64, ""), (65, "zz"), (None, "q q"), (60, "b"), (60, "b")]
    docs += [(66, text(4000) + shared), (67, "only here " * 4 + "only")]
    assert marked(spark, docs, items) == brute_force(docs, items)


def test_edges(spark):
    docs = [(1, "a b c"), (2, None)]
    for items in ([], [(1, None), (2, "..")]):
        assert marked(spark, docs, items) == brute_force(docs, items)
    assert marked(spark, [], [(1, "a")]) == []
    passage = " ".join(f"w{i}" for i in range(50))
    long = [(1, "word " * 400_000 + passage + " word" * 400_000), (2, "x" * 2_000_000 + " " + passage[:60])]
    assert marked(spark, long, [(7, passage)]) == brute_force(long, [(7, passage)])
