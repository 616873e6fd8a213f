import random
import re
import string

import numpy as np
import pytest

from sluicebox.llm import near_dedup, queries
from sluicebox.llm.components import components
from sluicebox.llm.hashing import Words
from sluicebox.llm.near_dedup import drop_near_copies, mark_near_copies, signature, similar

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sets_of(texts, words):
    found = {}
    for doc, text in texts:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
        found[doc] = frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    return found


def brute_force(texts, words, percent=80):
    """By id: size of the set and the smallest id reachable."""
    sets = sets_of(texts, words)
    having, root = {}, {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for doc in sorted(sets):
        shared = {}
        for shingle in sets[doc]:
            for other in having.setdefault(shingle, []):
                shared[other] = shared.get(other, 0) + 1
            having[shingle].append(doc)
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[doc]) + len(sets[other]) - n):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def found_of(df):
    return {row.doc_id: (row.n_shingles, row.component_id) for row in df.collect()}


def test_query_equals_brute_force(spark):
    texts = [(row.doc_id, row.text) for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows = queries.op10_minhash_dedup(spark, "/root/testdata/sf0.01")
    assert found_of(rows) == brute_force(texts, 4)
    assert rows.where("kept <> (doc_id = component_id)").isEmpty()


@pytest.mark.parametrize("block", [16, 2048])
def test_a_family_of_near_copies_about_the_threshold(spark, monkeypatch, block):
    """Copies with a few words changed: many pairs are near 0.8, and a bucket holds members that are not linked."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    random.seed(4)
    base = ["".join(random.choices("abcdefg", k=5)) for _ in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for place in random.sample(range(120), random.randint(1, 9)):
            words[place] = f"new{random.random()}"
        texts.append((1000 - i, (" " if i % 2 else "\n").join(words).upper() if i % 3 else " ".join(words)))
    texts += [(2000 + i, "  ".join(base)) for i in range(20)] + [(3000, "one two"), (3001, "ONE\ttwo"), (3002, "two one")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert found_of(mark_near_copies(df)) == brute_force(texts, 5)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, long + " end"), (None, long), (6, "a b c"), (6, "a b c"), (7, "A B C"), (8, "É b"), (9, "é b")]
    df = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, component_id string")
    found = sorted((row.doc_id or 0, row.n_shingles, row.component_id, row.kept) for row in mark_near_copies(df).collect())
    size = 30_000 - 4
    assert found == [
        (0, size, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, size, 4, True), (5, size + 1, 4, False),
        (6, 1, 6, True), (6, 1, 6, True), (7, 1, 6, False), (8, 1, 8, True), (9, 1, 9, True),
    ]
    kept = drop_near_copies(df)
    assert kept.columns == df.columns and sorted(row.doc_id or 0 for row in kept.collect()) == [0, 1, 2, 3, 4, 6, 6, 8, 9]
    assert mark_near_copies(df.limit(0)).collect() == [] and drop_near_copies(df.limit(0)).collect() == []


def test_ids_with_several_texts_lose_no_link(spark):
    """Whatever the order of the rows; the texts of one id count as linked."""
    draw = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in draw.integers(0, 500, 200)) for _ in range(4)]
    rows = [(1, base[0]), (1, base[1]), (5, base[0] + " x"), (6, base[1] + " x"), (7, base[2]), (9, base[3]), (9, base[2] + " x"), (10, base[3] + " y")]
    rows += [(12, "other text alone in here"), (12, None), (13, None), (5, base[0] + " x")]
    for seed in range(2):
        some = [rows[i] for i in np.random.default_rng(seed).permutation(len(rows))]
        found = mark_near_copies(spark.createDataFrame(some, "doc_id long, text string").repartition(3)).collect()
        assert len(found) == len(rows)
        components_of = {}
        for row in found:
            components_of.setdefault(row.doc_id, set()).add(row.component_id)
            assert row.kept == (row.doc_id == row.component_id)
        assert components_of == {1: {1}, 5: {1}, 6: {1}, 7: {7}, 9: {7}, 10: {7}, 12: {12}, 13: {13}}


def test_components_of_paths_stars_and_cycles(spark):
    draw = np.random.default_rng(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    edges += [(int(a), int(b)) for a, b in draw.integers(1000, 1100, (60, 2))]
    root = {x: x for edge in edges for x in edge}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame([*edges, *edges[:9], (None, 1)], "a long, b long")
    found = {row.node: row.component for row in components(df).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root[x] for x in linked}
    assert components(df.limit(0)).collect() == []


def test_signatures_estimate_the_similarity():
    draw = np.random.default_rng(3)
    shingles = np.unique(draw.integers(0, 1 << 63, 4000, dtype=np.uint64))
    x, y = shingles[:3600], shingles[400:4000]
    assert abs((signature(x) == signature(y)).mean() - 3200 / 4000) < 0.12
    assert similar(x, y, 80) and not similar(x, shingles[401:4000], 80)


def test_word_hashes_do_not_depend_on_what_is_around():
    alone = Words([b"Word"]).hashes()[0]
    words = Words([b"", b" word\x0bWORD,", b"\t\nword wordy"])
    assert words.first.tolist() == [0, 0, 2, 4]
    assert (words.hashes() == alone).tolist() == [True, False, True, False]
    assert len(set(words.hashes(4).tolist())) == 2
