import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import neighbours
from docweave.llm.neighbours import Tree, chi_square_quantile, nearest
from docweave.llm.queries import QUERIES


def brute(vectors, k):
    """For each id divisible by 50: (rank, id, cosine) of its nearest."""
    ids = np.array(sorted(vectors))
    unit = np.array([vectors[i] for i in ids], float)
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    out = {}
    for n, q in enumerate(ids):
        if q % 50 == 0:
            score = (unit * unit[n]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != n][:k]
            out[int(q)] = [(r + 1, int(ids[j]), score[j]) for r, j in enumerate(order)]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash") for i, v in rows], "id long, vec array<float>, cell string")


def found(spark, rows, k=5):
    out = {}
    for r in nearest(table(spark, rows), F.col("id") % 50 == 0, k).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def recall(got, want):
    hits = sum(len({i for _, i, _ in want[q]} & {i for _, i, _ in got.get(q, [])}) for q in want)
    return hits / sum(map(len, want.values()))


def test_quantiles():
    assert chi_square_quantile(0.95, 2) == pytest.approx(-2 * math.log(0.05))
    assert chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_tree_yields_all_rows_nearest_boxes_first():
    points = np.random.default_rng(1).standard_normal((500, 4))
    points[:200] = points[0]
    tree = Tree(points, 16)
    seen = list(tree.incremental(np.zeros(4)))
    assert sorted(np.concatenate([r for _, r in seen])) == list(range(500))
    assert [a for a, _ in seen] == sorted(a for a, _ in seen)
    cells = tree.cells(points)
    assert {frozenset(np.flatnonzero(cells == c)) for c in set(cells)} == {frozenset(r) for _, r in seen}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 32))
    rows = [(i, (centres[i % 12] + 0.6 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(2500)]
    hot = rows[50][1]
    return [(i, hot if i % 3 == 0 else v) for i, v in rows]


def test_recall_with_a_third_of_all_rows_alike(spark, clustered, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    want, got = brute(dict(clustered), 5), found(spark, clustered)
    assert recall(got, want) >= 0.9
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5]
        assert q not in [i for _, i, _ in rows]
        if q % 3 == 0:  # the smallest ids of the many that are alike, but for its own
            assert [i for _, i, _ in rows] == [i for _, i, _ in want[q]]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.1]), (1, [2.0, 0.0]), (100, [-1.0, 0.0]), (50, [1e-30, 1e-30])]
    got = found(spark, rows)
    assert {q: [i for _, i, _ in v] for q, v in got.items()} == {0: [1, 50, 2, 100], 50: [0, 1, 2, 100], 100: [2, 50, 0, 1]}
    assert got[0][0][2] == 1.0 and got[0][1][2] == pytest.approx(math.sqrt(0.5)) and got[0][3][2] == -1.0


def test_no_rows(spark):
    assert found(spark, []) == {}
    assert found(spark, [(50, [1.0])]) == {}
    assert found(spark, [(50, None)]) == {}


def test_query_recall(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    want, got = brute(rows, 5), {}
    for r in QUERIES["op1_nearest_neighbours"](spark, folder).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want) and recall(got, want) >= 0.9
    unit = {i: np.array(v, float) / np.sqrt((np.array(v, float) ** 2).sum()) for i, v in rows.items()}
    assert all(s == pytest.approx(float(unit[q] @ unit[i]), abs=1e-12) for q, v in got.items() for _, i, s in v)
