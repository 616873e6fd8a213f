import numpy as np
import pytest

from sluicebox.llm import queries, vector_dedup
from sluicebox.llm.vector_dedup import mark_near_vectors, passes_for, unit


def brute_force(rows, cosine=0.95):
    """By place: number of links and the smallest id reachable."""
    units = [unit(vector) if row_id is not None else None for row_id, vector in rows]
    n, label = [0] * len(rows), [row_id for row_id, _ in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine
    ]
    for i, j in links:
        n[i] += 1
        n[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return n, label


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_query_equals_brute_force(spark, folder):
    rows = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").collect()]
    n, label = brute_force(rows)
    found = {row.vec_id: (row.n_links, row.component_id, row.kept) for row in queries.op6_sorted_projections(spark, f"/root/testdata/{folder}").collect()}
    assert found == {row[0]: (n[i], label[i], label[i] == row[0]) for i, row in enumerate(rows)}


@pytest.mark.parametrize("block", [4, 1024])
def test_groups_larger_than_window_and_block(spark, monkeypatch, block):
    """A group of near copies, chains, cosines about the threshold and copies of one vector."""
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    draw = np.random.default_rng(5)
    base = draw.normal(size=(6, 24))
    near = base[0] + 0.04 * draw.normal(size=(60, 24))
    chain = [np.cos(a) * base[1] / np.linalg.norm(base[1]) + np.sin(a) * base[2] / np.linalg.norm(base[2]) for a in np.arange(0, 1.2, 0.2)]
    edge = []
    for target in (0.9489, 0.9499999, 0.9500001, 0.951):
        x = draw.normal(size=24)
        y = draw.normal(size=24)
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        edge += [x, target * x + np.sqrt(1 - target**2) * y]
    vectors = [*near, *chain, *edge, *[base[5]] * 7, 3 * base[5], *draw.normal(size=(80, 24))]
    order = draw.permutation(len(vectors))
    rows = [(int(i), [float(x) for x in vectors[i]]) for i in order]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    n, label = brute_force(rows)
    found = {row.vec_id: (row.n_links, row.component_id) for row in mark_near_vectors(df, window=8).collect()}
    assert found == {row[0]: (n[i], label[i]) for i, row in enumerate(rows)}


def test_pairs_in_a_hot_region_are_found(spark, monkeypatch):
    """A third of the vectors about one direction, with a mutual cosine of 0.85, and pairs with no other link."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    draw = np.random.default_rng(11)
    x = draw.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:1300] = np.sqrt(0.85) * x[-1] + np.sqrt(0.15) * x[:1300]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = draw.normal(size=(200, 64))
    away -= (away * x[:200]).sum(axis=1, keepdims=True) * x[:200]
    x[200:400] = 0.952 * x[:200] + np.sqrt(1 - 0.952**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    n = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert n[:400].sum() >= 400
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    found = {row.vec_id: row.n_links for row in mark_near_vectors(df, window=16).collect()}
    assert found == dict(enumerate(n.tolist()))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1e300, 1e300]),
        (8, [1e-300, 1e-300]), (8, [1e-300, 1e-300]), (9, [1.0, 1.0, 0.0]), (None, [1.0, 1.0]), (10, [1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*row, 0) for row in rows], "vec_id long, embedding array<double>, n_links int")
    found = sorted(((row.vec_id or 0), row.n_links, row.component_id, row.kept) for row in mark_near_vectors(df).collect())
    expected = [(0, 0, None, True), *[(i, 0, i, True) for i in range(1, 7)], (7, 2, 7, True), (8, 2, 7, False), (8, 2, 7, False)]
    assert found == [*expected, (9, 0, 9, True), (10, 0, 10, True)]
    assert mark_near_vectors(df.limit(0)).collect() == []


def test_passes_grow_slowly_with_the_number_of_vectors():
    assert passes_for(1) == passes_for(100) == 1
    assert passes_for(10_000) < passes_for(1_000_000) < passes_for(1_000_000_000) < 150
