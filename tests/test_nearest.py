"""Top-k search by balls against all products, and what it leaves unsent."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from picsift.operators import nearest, similarity
from picsift.operators.similarity import top_k


def clustered(clusters, each, dims, spread, seed=0):
    rng = np.random.default_rng(seed)
    x = np.repeat(rng.standard_normal((clusters, dims)), each, axis=0) + spread * rng.standard_normal((clusters * each, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(x)], "k long, v array<double>")


def brute(q, c, k, same=False):
    s = np.round(q @ c.T, 9)
    if same:
        np.fill_diagonal(s, -np.inf)
    return {(i, r, int(j)) for i in range(len(q)) for r, j in enumerate(np.lexsort((np.arange(len(c)), -s[i]))[:k], 1) if np.isfinite(s[i, j])}


def got(df):
    return {(r.query_id, r["rank"], r.neighbor_id) for r in df.collect()}


@pytest.fixture
def used(monkeypatch):
    """Whether the balls were taken; many of them for few rows."""
    real, out = similarity._top_k_by_balls, []
    monkeypatch.setattr(similarity, "_top_k_by_balls", lambda *a, **o: out.append(real(*a, **o)) or out[-1])
    monkeypatch.setattr(nearest, "ROWS_PER_PIVOT", 8)
    return out


def test_clusters_are_found_and_far_blocks_are_not_shipped(spark, monkeypatch, used):
    x = clustered(60, 12, 16, 0.05)
    shipped = []
    real = similarity._block_tops
    monkeypatch.setattr(similarity, "_block_tops", lambda rows, *a: shipped.append(rows.count()) or real(rows, *a))
    assert got(top_k(frame(spark, x), frame(spark, x), "k", "v", 5, True, block_rows=40)) == brute(x, x, 5, True)
    assert used[-1] is not None
    blocks = len(x) / 40
    assert sum(shipped) < 0.4 * 2 * len(x) * blocks                  # hashed blocks ship every row to every block


def test_queries_of_any_length_far_from_everything_and_ties(spark, used):
    c = clustered(40, 10, 8, 0.1, seed=1)
    c[100:180] = c[100]                                              # eighty equal rows, more than a block
    q = np.concatenate([3.5 * c[:6], 0.01 * -c[6:9], np.zeros((1, 8)), c[100:102]])
    for k in (1, 7, 90):
        mine = got(top_k(frame(spark, q), frame(spark, c), "k", "v", k, block_rows=32))
        s = np.round(q @ c.T, 9)
        assert len(mine) == len(q) * k
        for i in range(len(q)):
            found = [j for _, j in sorted((r, j) for a, r, j in mine if a == i)]
            assert np.allclose(s[i, found], np.sort(s[i])[::-1][:k], atol=1e-9)


def test_rows_without_unit_length_and_unclustered_rows_go_the_other_way(spark, used):
    x = clustered(30, 10, 6, 0.05, seed=2)
    assert got(top_k(frame(spark, x[:9]), frame(spark, 2 * x), "k", "v", 3, block_rows=50)) == brute(x[:9], 2 * x, 3)
    loose = clustered(200, 1, 48, 1.0, seed=3)
    assert got(top_k(frame(spark, loose), frame(spark, loose), "k", "v", 4, block_rows=60)) == brute(loose, loose, 4)
    assert used == [None, None]


@given(st.integers(0, 2**32), st.integers(1, 12))
@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_clusters(spark, used, seed, k):
    x = clustered(25, 9, 5, 0.1, seed=seed)
    assert got(top_k(frame(spark, x[::3]), frame(spark, x), "k", "v", k, block_rows=30)) == brute(x[::3], x, k)


def test_unclustered_rows_are_asked_for_few_visits(spark, used, monkeypatch):
    """Where balls don't pay a few queries show it: no pass over all of them."""
    monkeypatch.setattr(similarity, "ASKED", 20)
    seen = []
    real = nearest.first_balls
    monkeypatch.setattr(nearest, "first_balls", lambda q, *a: seen.append(q.count()) or real(q, *a))
    loose = clustered(300, 1, 48, 1.0, seed=3)
    assert got(top_k(frame(spark, loose), frame(spark, loose), "k", "v", 4, True, block_rows=30)) == brute(loose, loose, 4, True)
    assert used == [None] and seen == [20]


@given(st.integers(0, 2**32), st.integers(1, 9), st.booleans())
@settings(max_examples=30, deadline=None)
def test_best_of_a_block(seed, k, same):
    """Float products only choose whom to look at: ties, copies, lengths and rows without a number."""
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    c = rng.standard_normal((2600, 6)) * rng.choice([1e-3, 1.0, 40.0])
    c[rng.integers(0, 2600, 900)] = c[5]
    c[7, 2] = np.nan
    q = np.concatenate([c[:9], c[5:6]])
    table = pa.table({"_k": np.concatenate([np.arange(10), np.arange(2600)]), "_v": pa.array([*q.tolist(), *c.tolist()]),
                      "_side": np.repeat([0, 1], [10, 2600])})
    out = similarity._topk_block_fn(k, same)(table)
    mine = {(a, r): s for a, r, s in zip(*(out[n].to_pylist() for n in ("query_id", "rank", "sim")))}
    s = q @ c.T
    if same:
        s[np.arange(10), np.arange(10)] = np.nan
    for i in range(10):
        best = np.sort(s[i][np.isfinite(s[i])])[::-1][:k]
        assert np.allclose([mine.pop((i, r)) for r in range(1, len(best) + 1)], best, rtol=1e-12, atol=1e-12 * 1600)
    assert not mine
