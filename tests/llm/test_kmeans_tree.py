import numpy as np
import pytest
from conftest import SF_DIR

from tideline.llm import kmeans_tree, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k=10):
    """Exact answers over rows that take part; of several vectors under one id the least counts."""
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v):
            seen[i, tuple(v)] = np.array(v, np.float32).astype(float)
    size = max(sorted({len(v) for _, v in seen}), key=lambda n: sum(len(v) == n for _, v in seen), default=0)
    of_size = sorted(((key, v) for key, v in seen.items() if len(v) == size), key=lambda item: item[0], reverse=True)
    seen = {(key[0],): v for key, v in of_size}
    out = []
    for (i,), vector in seen.items():
        if i in asked:
            near = sorted((float(np.sqrt(((v - vector) ** 2).sum())), j) for (j,), v in seen.items() if j != i)
            out += [(i, rank, j, d) for rank, (d, j) in enumerate(near[:k], 1)]
    return sorted(out)


def found(spark, rows, asked, **settings):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = kmeans_tree.neighbours(df, df.filter(df.vec_id.isin(sorted(asked))), **settings)
    return sorted(tuple(r) for r in got.collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=0)


def recall(got, want):
    got, want = ({(r[0], r[2]) for r in part} for part in (got, want))
    return len(got & want) / len(want)


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op12_kmeans_tree"](spark, SF_DIR).collect())
    want = brute(rows, {i for i, _ in rows if i % 100 == 0})
    assert len(got) == len(want) and recall(got, want) >= 0.9


@pytest.mark.parametrize("blocks", [(2048, 512), (16, 3)])
def test_clusters_ties_and_copies(spark, monkeypatch, blocks):
    """Full recall must give the exact answer, whatever the blocks; a third of all rows are one vector."""
    monkeypatch.setattr(kmeans_tree, "BLOCK_VECTORS", blocks[0])
    monkeypatch.setattr(kmeans_tree, "BLOCK_QUERIES", blocks[1])
    draw = np.random.default_rng(2)
    centres = draw.integers(-50, 50, (12, 6))
    vectors = [*(centres[draw.integers(0, 12, 400)] + draw.integers(-3, 4, (400, 6))), *[centres[0]] * 200]
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(draw.permutation(600) - 40, vectors)]
    asked = {i for i, _ in rows if i % 9 == 0}
    same(found(spark, rows, asked, recall=1.0), brute(rows, asked))


def test_recall_with_few_visits(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 24)) * 3
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(centres[draw.integers(0, 40, 2000)] + draw.normal(size=(2000, 24)))]
    asked = set(range(0, 2000, 20))
    assert recall(found(spark, rows, asked, k=5), brute(rows, asked, k=5)) >= 0.9
    # A tree of few sample vectors still holds every row.
    assert recall(found(spark, rows, asked, k=5, sample=100), brute(rows, asked, k=5)) >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0]), (7, []),
            (8, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (10, [-0.0, 1.0]), (10, [-0.0, 1.0]), (11, [5.0, 1.0]), (11, [6.0, 1.0])]
    for given in (rows, rows[:1], [], [r for r in rows if r[0] in (2, 3, 4)]):
        for k in (1, 10):
            same(found(spark, given, {0, 2, 3, 8, 10, 11}, k=k), brute(given, {0, 2, 3, 8, 10, 11}, k))
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, 1), (1, [2.0, 0.0], 2, 2)], "vec_id int, embedding array<double>, rank int, score int")
    got = kmeans_tree.neighbours(df, df.filter("vec_id = 0"))
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 1.0)]
    assert kmeans_tree.neighbours(df, df.filter("false")).collect() == []


def test_best_bin_first_visits_every_leaf_once():
    rows = np.random.default_rng(1).normal(size=(500, 8))
    tree = kmeans_tree.Tree(rows)
    order = tree.visits(rows[3], tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and tree.leaves > 20
    assert order[0] == tree.leaf_of(rows[3:4])[0]
