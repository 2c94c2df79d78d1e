import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedmill.llm import neighbours


def by_hand(rows, k, every=20):
    vectors = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in vectors:
        if q % every == 0:
            scored = sorted((-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
            out[q] = scored[:k]
    return out


def check(spark, rows, k=20, least=0.9):
    df = spark.createDataFrame([(i, v, 1, "h", 0) for i, v in rows], "vec_id long, embedding array<float>, h1 long, vec string, cell int")
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    got = {}
    for r in neighbours.search(df, F.col("id") % 20 == 0, k).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    want, hits, total, vectors = by_hand(rows, k), 0, 0, dict(rows)
    assert got.keys() == {q for q, best in want.items() if best}
    for q, best in want.items():
        mine = sorted(got.get(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(best) + 1)) and len({i for _, i, _ in mine}) == len(best)
        assert all(abs(s - np.dot(vectors[q], vectors[i])) < 1e-9 for _, i, s in mine) and q not in {i for _, i, _ in mine}
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hits += sum(s >= -best[-1][0] - 1e-9 for _, _, s in mine)
        total += len(best)
    assert not total or hits / total >= least
    return hits / total if total else 1.0


def test_random_clusters_and_lengths(spark):
    random = np.random.default_rng(4)
    centres = random.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + 0.2 * random.normal(size=16)) * random.uniform(0.5, 2)) for i in range(1500)]
    assert check(spark, [(i, v.tolist()) for i, v in rows]) >= 0.9


def test_ties_and_one_common_vector(spark):
    random = np.random.default_rng(6)
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(0, 120)] + [(i, random.normal(size=3).tolist()) for i in range(120, 300)]
    assert check(spark, rows) == 1.0


def test_few_rows(spark):
    assert check(spark, [(0, [1.0, 2.0])]) == 1.0
    assert check(spark, [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (3, [-1.0, 0.0])]) == 1.0


def test_rows_that_take_no_part(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 1.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, -0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (20, None), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (1, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in neighbours.query(df).collect()] == [(0, 1, 1, 1.0)]
    assert neighbours.query(df.limit(0)).collect() == []


@pytest.mark.parametrize("sure", [0.5, 0.9, 0.99])
def test_chi_square(sure):
    random = np.random.default_rng(8)
    sample = (random.normal(size=(200_000, neighbours.PROJECTIONS)) ** 2).sum(axis=1)
    assert abs((sample <= neighbours.chi_square_bound(sure)).mean() - sure) < 0.01


def test_tiles_of_a_crowded_cell(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    random = np.random.default_rng(9)
    rows = [(i, (random.normal(size=4) * (0.001 if i < 300 else 1) + 1).tolist()) for i in range(400)]
    assert check(spark, rows) >= 0.9
