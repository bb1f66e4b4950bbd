"""Exact top-k search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SPARK_ERRORS
from triptych.llm import vectorfile

VECTORS = "vec_id bigint, embedding array<double>, label int, v bigint, q string, vector string, members int"


def vectors():
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(700):
        x = centres[i % 6] + rng.normal(size=12) * 0.6
        rows.append((i, [float(y) for y in x / np.linalg.norm(x)]))
    rows += [(1000 + i, rows[50][1]) for i in range(300)]  # one very common vector, queries among them
    rows += [(2000, None), (2050, [0.0] * 12), (2100, []), (2150, [0.5, -0.25]), (2151, [0.5, math.nan]), (2152, [None, 1.0])]
    rows += [(2153, [math.inf]), (None, [1.0] * 12), (2200, rows[100][1]), (2200, rows[100][1]), (2250, [9.0e4] + [0.0] * 11)]
    return rows


def usable(x):
    return x is not None and all(y is not None and math.isfinite(y) for y in x)


def plain(rows, k):
    whole = [(i, [math.floor(256 * y) for y in x]) for i, x in rows if i is not None and usable(x)]
    out = []
    for at, (q, x) in enumerate(whole):
        if q % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(x, y)), i, j) for j, (i, y) in enumerate(whole) if j != at]
            out += [(q, rank + 1, i, -s) for rank, (s, i, _) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "clash", "clash", 3) for row in rows], VECTORS).repartition(4, "vec_id")


def found(df, **options):
    result = vectorfile.top_products(df, F.col("vec_id") % 50 == 0, **options)
    assert result.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, result.collect()))


@pytest.mark.parametrize(("bits", "k"), [(6, 5), (2, 5), (8, 1), (1, 7)])
def test_results_equal_brute_force_at_any_precision(spark, bits, k):
    assert found(table(spark, vectors()), bits=bits, k=k) == plain(vectors(), k)


def test_parts_of_queries_and_of_cells(spark, monkeypatch):
    monkeypatch.setattr(vectorfile, "_ROWS_PER_BLOCK", 64)
    monkeypatch.setattr(vectorfile, "_QUERIES_PER_BLOCK", 4)
    assert found(table(spark, vectors()), query_memory=1000) == plain(vectors(), 5)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0]), (50, [3.0]), (7, [-1.0, 0.001])]
    assert found(table(spark, rows)) == plain(rows, 5)
    assert found(table(spark, rows[:1])) == []


def test_bounds_hold_for_every_vector_and_query():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(900, 20)) * 80).astype(np.int32)
    x[5] *= 400  # far outside the grid
    mean, apart = x.mean(axis=0), 4 * x.std(axis=0)
    low, high = np.maximum(x.min(axis=0), mean - apart), np.minimum(x.max(axis=0), mean + apart)
    grid = vectorfile.Grid(low, (high - low + 1) / 16, 16)
    cells, radii = grid.approximate(x.astype(float))
    scan = vectorfile.Scan(np.arange(40), x[:40], grid, 900)
    scan.meet(np.arange(900), cells, radii)
    batch = scan.flush()
    q, v, lower, upper = (c.to_numpy() for c in batch.columns)
    exact = (x[:40].astype(np.int64) @ x.T.astype(np.int64))[q, v]
    assert len(q) == 40 * 900
    assert (lower <= exact).all() and (exact <= upper).all()


def test_few_exact_vectors_are_read(spark):
    """The scan leaves a small part of all pairs, without losing any of the result."""
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(4000, 32)) * 45).astype(np.int32)
    mean, apart = x.mean(axis=0), 4 * x.std(axis=0)
    grid = vectorfile.Grid(mean - apart, 8 * x.std(axis=0) / 64, 64)
    scan = vectorfile.Scan(np.arange(80), x[:80], grid, 6)
    for first in range(0, 4000, 500):
        scan.meet(np.arange(first, first + 500), *grid.approximate(x[first : first + 500].astype(float)))
    kept = scan.flush()
    assert kept.num_rows < 0.01 * 80 * 4000
    exact = x[:80].astype(np.int64) @ x.T.astype(np.int64)
    pairs = set(zip(kept.column(0).to_pylist(), kept.column(1).to_pylist()))
    for q in range(80):
        assert all((q, int(v)) in pairs for v in np.argsort(-exact[q])[:6])


def test_scores_beyond_64_bits_are_an_error(spark):
    with pytest.raises(SPARK_ERRORS):
        found(table(spark, [(0, [1e30]), (1, [1.0])]))


def test_empty_table(spark):
    assert found(table(spark, vectors()).limit(0)) == []
