import math
import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from picsift.llm import negatives as N

SF = "/root/testdata/sf0.001"
VECS = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """(anchor, positive, rank, negative, scores) by comparing everything with everything, in Python integers."""
    usable = []
    for vec_id, vec, label in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        usable.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vec]))
    out = []
    for a, la, va in {(a, la, tuple(va)) for a, la, va in usable if is_anchor(a)}:
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in usable)
        for minus, p in [(s, i) for s, i, label in scored if label == la and i != a][:positives]:
            fits = [(s, i) for s, i, label in scored if label != la and low * -minus <= 100 * -s <= high * -minus]
            out += [(a, p, r, i, -minus, -s) for r, (s, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, VECS)
    return sorted(map(tuple, N.mine(df, F.col("id") % 10 == 0, **options).collect()))


@given(st.integers(1, 70), st.integers(1, 70), st.integers(1, 70), st.integers(0, 2**32))
@settings(max_examples=30, deadline=None)
def test_strassen_is_exact_also_where_sums_wrap(m, k, n, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-1 << 62, 1 << 62, (m, k)), rng.integers(-1 << 62, 1 << 62, (k, n))
    assert (N.strassen(a, b, leaf=4) == a @ b).all()


@given(st.integers(-2**62, 2**62))
def test_window_ends(score):
    least, most = (int(x[0]) for x in N.window_of(np.array([score])))
    assert 100 * least >= 50 * score > 100 * (least - 1)
    assert 100 * most <= 95 * score < 100 * (most + 1)


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(-3, 3, (4, 60)), np.arange(60)
    allowed = rng.random((4, 60)) < 0.5
    whole = N.Heaps(4, 5)
    whole.push(scores, allowed, ids)
    parts = []
    for j in (40, 0, 20):
        h = N.Heaps(4, 5)
        h.push(scores[:, j:j + 20], allowed[:, j:j + 20], ids[j:j + 20])
        parts.append(h)
    merged = parts[0]
    for h in parts[1:]:
        merged.merge(h)
    assert [list(x) for x in merged.rows()] == [list(x) for x in whole.rows()]


def test_tiles_of_any_size_and_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(7)], i % 3) for i in range(200)]
    rows += [(300 + i, [0.5, 0.25, 0.5], 1) for i in range(40)]                      # ties; shorter vectors
    rows += [(7, rows[7][1], 1), (20, rows[20][1], 2), (20, rows[20][1], 2)]          # repeated rows, an anchor among them
    expected = brute(rows, lambda a: a % 10 == 0)
    none = [(None, [1.0], 1), (400, None, 1), (410, [1.0, None], 1), (420, [float("nan")], 1), (430, [float("inf")], 0),
            (440, [1.0], None), (450, [], 2)]
    rows += none[:-1]
    assert len(expected) > 100
    # (repeated non-anchor rows count again, a repeated anchor does not)
    assert mined(spark, rows) == expected
    assert mined(spark, rows, anchor_rows=5, candidate_rows=17) == expected
    assert mined(spark, rows + none[-1:]) == brute(rows + none[-1:], lambda a: a % 10 == 0)
    clash = spark.createDataFrame(rows, VECS).withColumns({c: F.lit(1) for c in ("anchor", "tile", "side", "v", "id", "score", "found")})
    assert mined(spark, clash) == expected
    assert mined(spark, spark.createDataFrame([], VECS)) == []


def test_a_third_of_the_rows_is_one_vector(spark):
    rng = random.Random(6)
    rows = [(i, [0.3, 0.6, 0.1] if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(3)], i % 4) for i in range(400)]
    assert mined(spark, rows, anchor_rows=8, candidate_rows=50) == brute(rows, lambda a: a % 10 == 0)


def test_huge_components_take_no_part(spark):
    rows = [(i, [0.1 * i, 1.0], i % 2) for i in range(30)]
    assert mined(spark, rows + [(100, [1e20, 0.0], 0)]) == mined(spark, rows)


def test_query(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    df = N.op11_negatives(spark, SF)
    assert dict(df.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                               "positive_score": "bigint", "negative_score": "bigint"}
    assert sorted(map(tuple, df.collect())) == brute(rows, lambda a: a % 50 == 0)
