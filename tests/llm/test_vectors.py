"""Operators 12 and 13 against plain numpy and plain Python."""

import math

import numpy as np
import pytest
import quarterdeck.llm.covertree as covertree
from pyspark.sql import functions as F
from quarterdeck.llm.covertree import fit, labelled_rows, mine, plant
from quarterdeck.llm.whitening import whiten, whole_numbers

SCHEMA = "vec_id long, embedding array<float>, label int, x string, leaf int, n long, component string, rank int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows, parts=5):
    floats = [(i, v and [None if c is None else float(c) for c in v], lab) for i, v, lab in rows]
    return spark.createDataFrame([(*r, "x", 7, None, None, 3) for r in floats], SCHEMA).repartition(parts)


def odd(vectors):
    """Rows that take no part, and repeated ones, among vectors of width 6."""
    rows = [(i, [float(np.float32(c)) for c in v], i % 3) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [1.0, None, 0, 0, 0, 0], 1), (902, [NAN] + [0.0] * 5, 1), (903, [INF] + [0.0] * 5, 2), (904, [], 1)]
    rows += [(905, [1.0, 2.0], 1), (906, [3e38] + [0.0] * 5, 1), (None, rows[3][1], 1), (350, [0.0] * 6, 2), (700, rows[10][1], 0)]
    return rows


# --- operator 12 ---


def usable(rows):
    return [(i, v) for i, v, _ in rows if v is not None and len(v) == 6 and all(c is not None and abs(c) < 1e12 for c in v)]


def whitened(rows):
    x = np.array([[math.floor(c * 1024) + 100_000 for c in v] for _, v in rows], np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[(int(c) * n - int(s)) / n for c, s in zip(r, sums, strict=True)] for r in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviations = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    return values, axes, centred, deviations


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = odd(rng.normal(size=(300, 6)) @ np.diag([9, 4, 2, 1, 0.5, 0.1]) @ rng.normal(size=(6, 6)) + 40)
    kept = usable(rows)
    values, axes, centred, deviations = whitened(kept)
    got = whiten(table(spark, rows))
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = got.collect()
    assert len(found) == len(kept) * 6 and {r["n"] for r in found} == {len(kept)}
    assert {r["identity_error"] for r in found}.pop() < 1e-12
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    signs = [np.sign(by[(kept[0][0], deviations[0])][c + 1]["whitened"] * (centred[0] @ axes[:, c])) for c in range(6)]
    for (i, _), row, far in zip(kept, centred, deviations, strict=True):
        mine_ = by[(i, far)]  # equal vectors have equal deviations: exact
        for c in range(6):
            assert mine_[c + 1]["whitened"] == pytest.approx(signs[c] * (row @ axes[:, c]) / math.sqrt(values[c]), abs=1e-8)
            assert mine_[c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
            assert int(mine_[c + 1]["deviation_exact"]) == far


def test_whitening_of_rows_without_full_rank(spark):
    """Two dimensions of variance in six: two components, and nothing made of rounding."""
    rng = np.random.default_rng(6)
    plane = rng.integers(-50, 50, (80, 2)) @ rng.integers(-3, 4, (2, 6))
    found = whiten(table(spark, [(i, [float(c) for c in v], 0) for i, v in enumerate(plane)])).collect()
    assert {r["component"] for r in found} == {1, 2} and max(r["identity_error"] for r in found) < 1e-9


def test_whitening_keeps_nearly_flat_components(spark):
    """Standard deviations 10^6 apart: the covariance, formed directly, would lose the smaller ones' digits."""
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(400, 6)) * np.array([1e5, 1e4, 1e3, 10, 1, 0.1])
    data = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(rows)]
    values, _, _, _ = whitened([(i, v) for i, v, _ in data])
    found = whiten(table(spark, data)).select("component", "explained", "identity_error").distinct().collect()
    assert len(found) == 6 and found[0]["identity_error"] < 1e-6
    for r in found:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-5)


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i * 10**8)] * 6, 0) for i in range(5)]
    x = [math.floor(i * 10**8 * 1024) + 100_000 for i in range(5)]
    found = {r["vec_id"]: r for r in whiten(table(spark, rows)).collect()}
    for i in range(5):
        far = 6 * (5 * x[i] - sum(x)) ** 2
        assert int(found[i]["deviation_exact"]) == far and found[i]["deviation"] == (far if far < 2**63 else None)


def test_whitening_without_rows_or_variance(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(1, None, 0), (2, [NAN], 0)])).count() == 0
    assert whiten(table(spark, [(i, [1.0, 2.0], 0) for i in range(9)])).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0], 0)])).count() == 0


def test_whole_numbers_of_equally_common_widths(spark):
    rows = table(spark, [(1, [0.5, -0.0001], 0), (2, [1.0], 0)])
    assert [(r["vec_id"], r["x"]) for r in whole_numbers(rows).collect()] == [(2, [101024])]


# --- operator 13 ---


def brute(rows, every):
    """The contract, row by row."""
    least = {}
    for i, v, lab in rows:
        if i is None or v is None or lab is None or len(v) != 6 or any(c is None or not abs(c) < 65536 for c in v):
            continue
        row = (lab, [math.floor(256 * c) for c in v])
        least[i] = min(least.get(i, row), row)
    out = []
    for a in sorted(i for i in least if i % every == 0):
        lab, q = least[a]
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, other) for i, (other, v) in least.items() if i != a)
        for positive, i, _ in [s for s in scored if s[2] == lab][:5]:
            fits = [s for s in scored if s[2] != lab and -50 * positive <= -100 * s[0] <= -95 * positive]
            out += [(a, i, k, j, -positive, -s) for k, (s, j, _) in enumerate(fits[:3], 1)]
    return out


def found(rows):
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("leaf_rows", [4, 40, 500])
def test_hard_negatives_of_clusters_against_brute_force(spark, monkeypatch, leaf_rows):
    """Clusters of other norms, repeated vectors (ties), a third of the rows the same vector, odd rows."""
    monkeypatch.setattr(covertree, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(covertree, "BLOCK", 50)
    monkeypatch.setattr(covertree, "PART", 8)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 6)) * rng.uniform(0.2, 4, (12, 1))
    vectors = centres[rng.integers(0, 12, 500)] + rng.normal(size=(500, 6)) * 0.1
    vectors[::3] = vectors[0]
    rows = odd(vectors)
    got = mine(table(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, 10)
    assert len(want) > 50 and found(got) == sorted(want)


def test_descent_skips_what_the_windows_exclude(spark, monkeypatch):
    """On well separated clusters the second descent leaves most nodes out."""
    monkeypatch.setattr(covertree, "LEAF_ROWS", 20)
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(30, 6)) * 5
    vectors = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 6)) * 0.02
    rows = labelled_rows(table(spark, [(i, [float(c) for c in v], i % 2) for i, v in enumerate(vectors)]), F.col("label"))
    tree = fit(rows)
    planted = plant(rows, tree).toPandas()
    leaves = planted.leaf.nunique()
    x = np.array(planted.x.tolist(), float)
    _, high = tree.bounds(x[:100])
    visited = []
    for i in range(100):
        floor = np.sort(x @ x[i])[-30]
        visited.append(len(tree.best_first(high[i], lambda node, i=i, floor=floor: high[i][node] >= floor)))
    assert leaves > 20 and np.mean(visited) < leaves / 4


def test_bounds_hold_for_every_row(spark, monkeypatch):
    monkeypatch.setattr(covertree, "LEAF_ROWS", 10)
    monkeypatch.setattr(covertree, "FIT_ROWS", 100)  # most rows are not in the sample
    rng = np.random.default_rng(13)
    vectors = np.concatenate([rng.normal(size=(400, 6)), rng.normal(size=(5, 6)) * 30, np.zeros((3, 6))])
    rows = labelled_rows(table(spark, [(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)]), F.col("label"))
    tree = fit(rows)
    planted = plant(rows, tree).toPandas()
    x, leaf = np.array(planted.x.tolist(), float), planted.leaf.to_numpy()
    low, high = tree.bounds(x)
    scores = x @ x.T
    for node in set(leaf):
        below = scores[:, leaf == node]
        assert (below >= low[:, [node]]).all() and (below <= high[:, [node]]).all()


def test_hard_negatives_of_odd_tables(spark):
    label, every = F.col("label"), F.col("vec_id") % 10 == 0
    assert mine(table(spark, []), every, label).count() == 0
    assert mine(table(spark, [(10, None, 1), (20, [NAN, 1.0], 1), (30, [1.0, 1.0], None)]), every, label).count() == 0
    assert mine(table(spark, [(10, [1.0, 0.0], 1)]), every, label).count() == 0  # no positives
    assert mine(table(spark, [(i, [1.0, 0.0], 1) for i in range(30)]), every, label).count() == 0  # no negatives
    zeros = table(spark, [(10, [0.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [3.0, 1.0], 2), (13, [1.0, 1.0], 2)])
    assert found(mine(zeros, every, label)) == [(10, 11, 1, 12, 0, 0), (10, 11, 2, 13, 0, 0)]
    against = table(spark, [(10, [1.0, 0.0], 1), (11, [-1.0, 0.0], 1), (12, [-1.0, 0.0], 2)])
    assert mine(against, every, label).count() == 0  # a score below 0 allows none


def test_large_components_stay_exact(spark):
    """Products beyond 2^53 are added up as whole numbers."""
    big = 65535.99
    rows = [(0, [big] * 6, 0), (1, [big] * 6, 0), (2, [big] * 5 + [big * 0.4], 1), (3, [big] * 5 + [big * 0.4 - 1 / 256], 1)]
    rows = [(i, [float(np.float32(c)) for c in v], lab) for i, v, lab in rows]
    assert found(mine(table(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"))) == sorted(brute(rows, 10))
