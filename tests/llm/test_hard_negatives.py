"""Hard negatives against exact products of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import plain_rows

from quillspark.llm import hard_negatives as H
from quillspark.llm import queries
from quillspark.llm.oracles import OP11

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    whole = []
    for vec_id, label, vec in rows:
        if None in (vec_id, label, vec) or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in vec):
            continue
        whole.append((vec_id, label, [math.floor(256 * x) for x in vec]))
    out = []
    for a_id, a_label, a in whole:
        if a_id % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v, strict=False)), vec_id, label) for vec_id, label, v in whole if vec_id != a_id]
        scored = sorted(s for s in scored if -(1 << 63) <= -s[0] < 1 << 63)
        for s, positive, _ in [x for x in scored if x[2] == a_label][:positives]:
            band = [x for x in scored if x[2] != a_label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a_id, positive, rank, x[1], -s, -x[0]) for rank, x in enumerate(band, 1)]
    return sorted(out)


def found(spark, rows, parts=3, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 50 == 0, **more).collect())


def vectors(seed, many, dim, decay=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, decay**k) for k in range(dim)] for _ in range(4)]
    return [(k, draw.randrange(3), [c + draw.gauss(0, 0.5 * decay**j) for j, c in enumerate(draw.choice(centres))]) for k in range(many)]


@pytest.mark.parametrize("decay", [1.0, 0.6])
def test_all_pairs(spark, monkeypatch, decay):
    monkeypatch.setattr(H, "ROWS", 37)
    monkeypatch.setattr(H, "ANCHORS", 3)
    rows = vectors(1, 600, 12, decay)
    want = brute(rows)
    assert len(want) > 100 and found(spark, rows) == want
    assert found(spark, rows, positives=2, negatives=7, low=10, high=99) == brute(rows, 2, 7, 10, 99)


def test_odd_rows(spark):
    rows = vectors(2, 220, 5)
    rows += [(None, 1, [1.0] * 5), (300, None, [1.0] * 5), (350, 1, None), (400, 1, [1.0, None, 1.0, 1.0, 1.0]), (450, 1, [float("nan")] * 5), (500, 1, [float("inf")] * 5), (550, 1, [1e308] * 5)]
    rows += [(600, 1, []), (650, 0, [2.0]), (651, 0, [1.0, 1.0, 1.0, 1.0, 1.0, 3.0, 9.0])]  # lengths differ
    rows += [rows[0], rows[3], rows[50]]  # repeated rows
    rows += [(1000 + k, k % 3, rows[100][2]) for k in range(40)]  # ties
    rows += [(2000, 1, [0.0] * 5), (2001, 2, [-1.0] * 5), (2050, 1, [-3.0] * 5)]
    assert found(spark, rows) == brute(rows)


def test_scores_of_any_size(spark):
    rows = [(k, k % 2, [float(x) * 2.0**e for x in v]) for e in (25, 33) for k, _, v in [(50 * e + r[0], 0, r[2]) for r in vectors(3, 30, 4)]]
    assert found(spark, rows) == brute(rows)


def test_one_label_holds_most_rows_and_copies(spark, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 64)
    rows = [(k, 7 if k % 4 else k % 3, v if k % 3 else [1.0] * 8) for k, _, v in vectors(4, 500, 8)]
    assert found(spark, rows) == brute(rows)


def test_empty_tables_and_clashing_names(spark):
    assert found(spark, []) == [] and found(spark, [(50, None, None)]) == [] and found(spark, [(50, 1, [1.0])]) == []
    df = spark.createDataFrame([(k, l, v, 1, 2) for k, l, v in vectors(5, 120, 4)], SCHEMA + ", score int, `g` int")
    assert sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 50 == 0).collect()) == brute(vectors(5, 120, 4))


def test_bounds_discard_and_never_hide(monkeypatch):
    """Pairs outside the bounds are discarded early when the length is in few components; lower and upper bounds hold the exact score."""
    rows = vectors(6, 400, 32, 0.7)
    ints = np.floor(256 * np.array([v for _, _, v in rows]))
    _, axes = np.linalg.eigh(ints.T @ ints)
    axes, cuts = np.ascontiguousarray(axes[:, ::-1]), (4, 8, 32)
    side = H._Side(np.arange(400).tobytes(), np.zeros(400, np.int64).tobytes(), "float64", ints.tobytes(), axes, cuts)
    exact, looks = ints @ ints.T, []

    def keep(lower, upper):
        assert (lower <= exact).all() and (exact <= upper).all()
        looks.append(np.count_nonzero(upper >= exact.max() * 0.9))
        return upper >= exact.max() * 0.9

    one, other, score = H._survivors(side, side, cuts, keep)
    assert set(zip(*np.nonzero(exact >= exact.max() * 0.9), strict=True)) <= set(zip(one, other, strict=True))
    assert (score == exact[one, other]).all() and len(looks) < 3 and looks[-1] < 400 * 400 / 30


def test_the_query_gives_the_rows_of_sql(spark, duck, sf_dir):
    df = queries.op11_hard_negatives(spark, sf_dir)
    want = duck.sql(OP11)
    got = [tuple(r) for r in df.collect()]
    assert got and sorted(df.columns) == sorted(want.columns)
    assert plain_rows(df.columns, got) == plain_rows(want.columns, want.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
