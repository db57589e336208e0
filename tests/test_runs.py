"""Regressions of many runs in one plan, against the same run by run in numpy."""

import numpy as np
import pytest

from loomframe.operators import blocks, linear, runs

RNG = np.random.default_rng(12)
FRAMES = {0: 18, 3: 25, 7: 12}
Y = {r: RNG.normal(size=(14 + r, t)) + RNG.normal(size=(14 + r, 1)) * 4 for r, t in FRAMES.items()}
X = {r: RNG.normal(size=(t, 4)) * [1, 5, 0.1, 2] for r, t in FRAMES.items()}


@pytest.fixture
def vectors(spark):
    return spark.createDataFrame([(r, i, [float(v) for v in row]) for r, y in Y.items() for i, row in enumerate(y)], "run int, node_id long, ts array<double>")


def columns(spark, x, name):
    rows = [(r, t, c, float(m[t, c])) for r, m in x.items() for t in range(len(m)) for c in range(m.shape[1])]
    return runs.packed(spark.createDataFrame(rows, "run int, frame int, column int, value double"), name)


def by_run(df, col="ts"):
    out = {}
    for row in df.orderBy("run", "node_id").collect():
        out.setdefault(row.run, []).append(row[col])
    return {r: np.array(v) for r, v in out.items()}


def ids(spark, keep, kind="run int, node_id long"):
    return spark.createDataFrame([(r, i) for r in Y for i in range(len(Y[r])) if keep(r, i)], kind)


@pytest.mark.parametrize("most", [4096, 5])
def test_designs_of_each_run(spark, vectors, most, monkeypatch):
    monkeypatch.setattr(blocks, "MOST", most)
    design = columns(spark, X, "design")
    got = by_run(runs.regress_out(vectors, design))
    for r in Y:
        assert np.allclose(got[r], Y[r] - Y[r] @ np.linalg.pinv(X[r]).T @ X[r].T)
    keep = spark.createDataFrame([(r, t, t % 4 != 1) for r in Y for t in range(FRAMES[r]) if r != 7], "run int, frame int, keep boolean")
    got = by_run(runs.nuisance_regression(vectors, design, keep, 9.0))
    for r in Y:
        basis = linear.condition_design(X[r], 9.0)
        kept = np.arange(FRAMES[r]) % 4 != 1 if r != 7 else np.ones(12, bool)
        beta = np.linalg.lstsq(np.column_stack([basis, np.ones(FRAMES[r])])[kept], Y[r][:, kept].T, rcond=None)[0]
        assert np.allclose(got[r], Y[r] - (basis @ beta[:-1]).T)


def test_components_of_each_run(spark, vectors):
    mixing, noise = columns(spark, X, "mixing"), spark.createDataFrame([(0, 1), (0, 3), (3, 0)], "run int, component_id int")
    bad = {0: [1, 3], 3: [0], 7: []}
    got = by_run(runs.remove_components(vectors, mixing, noise))
    maps = runs.component_beta_maps(vectors, mixing).orderBy("run", "node_id", "component_id").toPandas()
    motion = columns(spark, {r: x[:, :2] ** 2 for r, x in X.items()}, "motion")
    stages = runs.variance_decomposition(vectors, mixing, noise, motion, 4.0).orderBy("run", "node_id").toPandas()
    for r in Y:
        beta = np.linalg.lstsq(X[r], Y[r].T, rcond=None)[0]
        assert np.allclose(got[r], Y[r] - (X[r][:, bad[r]] @ beta[bad[r]]).T)
        assert np.allclose(maps[maps["run"] == r]["loading"], np.linalg.lstsq(np.column_stack([X[r], np.ones(FRAMES[r])]), Y[r].T, rcond=None)[0][:-1].T.ravel())
        one = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(Y[r])], "node_id long, ts array<double>")
        want = linear.variance_decomposition(one, X[r], bad[r], X[r][:, :2] ** 2, linear.highpass_matrix(FRAMES[r], 4.0)).orderBy("node_id").toPandas()
        assert np.allclose(stages[stages["run"] == r][runs.STAGES], want[runs.STAGES])


def leading(y, cond):
    u, s, _ = np.linalg.svd((y - y.mean(1, keepdims=True)).T, full_matrices=False)
    k = int((s[0] <= np.sqrt(cond) * s).sum())
    return u[:, :k], s[:k] ** 2


@pytest.mark.parametrize("held", [1 << 24, 10])
def test_compartments_of_each_run(spark, vectors, held, monkeypatch):
    monkeypatch.setattr(runs, "HELD", held)
    mask = ids(spark, lambda r, i: i % 2 == 0 and r != 7)
    rows = {r.run: r for r in runs.compartment_components(vectors.repartition(5), mask, 4.0).collect()}
    for r in (0, 3):
        basis, values = leading(Y[r][::2], 4.0)
        mine = np.array(rows[r].basis).reshape(FRAMES[r], -1)
        assert mine.shape == basis.shape and np.allclose(mine @ mine.T, basis @ basis.T) and np.allclose(rows[r].eigenvalues, values)
    assert rows[7].basis_cols == 0 and rows[7].basis == []


def test_whole_chain(spark, vectors):
    ribbon, tissue, brain = ids(spark, lambda r, i: i % 3 == 0), ids(spark, lambda r, i: i % 3 == 1), ids(spark, lambda r, i: i % 5 > 0)
    none = ids(spark, lambda r, i: i == 2 and r == 0)
    motion = spark.createDataFrame([(r, t, c, float(X[r][t, c])) for r in Y for t in range(FRAMES[r]) for c in range(2)], "run int, frame int, column int, value double")
    keep = spark.createDataFrame([(r, 1, False) for r in Y], "run int, frame int, keep boolean")
    plan = runs.denoise(vectors, [tissue, none], ribbon, motion, brain, keep, 3.0, 30.0)
    got = by_run(plan)
    for r, y in Y.items():
        gs = y[::3].mean(0)
        parts = [leading(y[1::3], 3.0)[0]] + ([leading(y[2:3], 3.0)[0]] if r == 0 else []) + [gs[:, None], np.r_[0, np.diff(gs)][:, None], X[r][:, :2]]
        basis = linear.condition_design(np.hstack(parts), 30.0)
        kept = np.arange(FRAMES[r]) != 1
        beta = np.linalg.lstsq(np.column_stack([basis, np.ones(FRAMES[r])])[kept], y[:, kept].T, rcond=None)[0]
        want = y - (basis @ beta[:-1]).T
        want[::5] = y[::5]
        assert np.allclose(got[r], want)


def test_errors(spark, vectors):
    design = columns(spark, {0: X[0], 3: X[3]}, "design")
    with pytest.raises(Exception, match="run 7 has 0 matrices"):
        runs.regress_out(vectors, design).collect()
    few = spark.createDataFrame([(7, t, t == 0) for t in range(12)], "run int, frame int, keep boolean")
    with pytest.raises(Exception, match="fewer than two frames"):
        runs.nuisance_regression(vectors, columns(spark, X, "design"), few).collect()


def test_run_vectors(spark):
    s = spark.createDataFrame([(0, 1, 5, 1.0), (0, 1, 7, 3.0), (0, 2, 6, 2.0), (1, 1, 9, 4.0), (1, 2, 9, None)], "run int, node_id long, frame int, value double")
    assert sorted((r.run, r.node_id, r.ts) for r in runs.run_vectors(s).collect()) == [(0, 1, [1.0, 0.0, 3.0]), (0, 2, [0.0, 2.0, 0.0]), (1, 1, [4.0])]
