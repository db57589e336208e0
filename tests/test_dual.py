"""Chained dual regressions, exclusive regression and block products against numpy on whole matrices."""

import numpy as np
import pytest

from loomframe.operators import blocks, dual
from loomframe.operators.joins import near_pairs
from loomframe.plans import catalog, linear_queries
from loomframe.plans.adapters import nodes as node_table
from loomframe.plans.adapters import vectors as vector_table

SF = "/root/testdata/sf0.001"
RNG = np.random.default_rng(9)


def frame(spark, m, name, schema="node_id long, {} array<double>"):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(m)], schema.format(name))


def demean(m, axis=0):
    return m - m.mean(axis, keepdims=True)


def normalise(m):
    return demean(m) / np.maximum(m.std(0, ddof=1), 1e-5)


def weighted(maps, y, w):
    """Weighted dual regression, by whole matrices."""
    root = np.sqrt(w)[:, None]
    series = demean((np.linalg.pinv(demean(maps * root)) @ demean(y * root)).T)
    return (np.linalg.pinv(normalise(series)) @ demean(y, 1).T).T, series


def smoothed(xyz, v, mm, sigma):
    d = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(2))
    w = np.where(d <= mm, np.exp(-(d**2) / (2 * sigma**2)), 0)
    return w @ v / w.sum(1)


def reweighted(y, low, group, xyz, mm, sigma, areas):
    found = []
    for maps in low:
        own = weighted(weighted(maps, y, areas)[0], y, areas)[0]
        found.append(np.arctanh(np.clip([np.corrcoef(a, b)[0, 1] for a, b in zip(own, maps)], -1 + 1e-6, 1 - 1e-6)))
    q = np.mean(found, 0)
    w = np.maximum(0, q.mean() + q - smoothed(xyz, q, mm, sigma)) ** 3
    return *weighted(normalise(weighted(group, y, areas * w)[0]), y, areas), w


def test_weighted_dual_regression(spark):
    y, maps, w = RNG.normal(size=(80, 30)), RNG.normal(size=(80, 4)), RNG.uniform(0.2, 2, 80)
    y += maps @ RNG.normal(size=(4, 30)) * 2 + 5
    for weights in (None, w):
        got = dual.weighted_dual_regression(frame(spark, y, "ts"), frame(spark, maps, "a"), None if weights is None else spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "node_id long, w double"))
        b, series = weighted(maps, y, np.ones(80) if weights is None else w)
        assert np.allclose(got.series, series)
        assert np.allclose([r.b for r in got.maps.orderBy("node_id").collect()], b)


def test_alignment_query_is_the_whole_matrix_form(spark):
    rows = vector_table(spark, SF).orderBy("node_id").collect()
    y, label, ids = np.array([r.ts for r in rows]), np.array([r.label_id for r in rows]), np.array([r.node_id for r in rows])
    xyz = np.array([(r.x, r.y, r.z) for r in node_table(spark, SF).orderBy("node_id").collect()])
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    like = lambda k: unit(y) @ unit(np.array([y[k == c].mean(0) for c in np.unique(k)])).T
    b, _, w = reweighted(y, [like(label), like(ids % 5)], like(label * 2 + ids % 2), xyz, 0.08, 0.05, np.abs(xyz[:, 0]) + 0.5)
    got = catalog.QUERIES["L14_alignment_weights"](spark, SF).orderBy("node_id", "component_id").toPandas()
    assert np.allclose(got["loading"], b.ravel(), atol=2e-6)
    assert np.allclose(got["w"].to_numpy().reshape(len(y), -1)[:, 0], w, atol=2e-6)


def exclusive(maps, y, above=0.5):
    """Leading components of the deflated matrices by whole SVDs."""
    out = []
    for j in range(maps.shape[1]):
        others = demean(np.delete(maps, j, 1))
        p = np.linalg.pinv(others)
        left = maps[:, j] - others @ (p @ demean(maps[:, j]))
        rest = demean(demean(y) - others @ (p @ demean(y)), 1)
        sd = np.maximum(rest.std(1, ddof=1), np.finfo(float).eps)
        u, s, v = np.linalg.svd(left[:, None] / sd[:, None] * rest, full_matrices=False)
        high = left > above
        v = np.sign(u[high, 0].mean()) * np.median(np.abs(u[high, 0]) * sd[high]) * s[0] * v[0] if high.any() else np.full(y.shape[1], np.nan)
        out.append(v - v.mean())
    return np.array(out)


@pytest.mark.parametrize("shape", [(90, 25, 4), (61, 7, 3), (40, 3, 1)])
def test_exclusive_regression_is_the_leading_component(spark, shape):
    n, t, k = shape
    maps = np.abs(RNG.normal(size=(n, k)))
    y = RNG.normal(size=(n, t)) + maps @ RNG.normal(size=(k, t))
    long_ = spark.createDataFrame([(c, i, float(maps[i, c])) for c in range(k) for i in range(n)], "component_id int, node_id long, loading double")
    got = dual.exclusive_regression(long_, frame(spark, y, "ts"), block=2).orderBy("component_id", "frame").toPandas()
    assert np.allclose(got["value"].to_numpy().reshape(k, t), exclusive(maps, y), atol=1e-8)


def test_exclusive_query_with_dependent_maps(spark):
    rows = linear_queries.wide_signal(spark, SF).orderBy("node_id").collect()
    y, ids = np.array([r.ts for r in rows]), np.array([r.node_id for r in rows])
    maps = np.stack([ids % 2, ids % 3, np.ones(len(ids))], 1).astype(float)
    got = catalog.QUERIES["L34_exclusive_regression"](spark, SF).orderBy("component_id", "frame").toPandas()
    assert np.allclose(got["value"].to_numpy().reshape(3, -1), exclusive(maps, y), atol=1e-5)


def test_a_component_without_high_nodes_has_null_values(spark):
    maps = spark.createDataFrame([(0, i, 0.1 * (i % 3)) for i in range(9)], "component_id int, node_id long, loading double")
    got = dual.exclusive_regression(maps, frame(spark, RNG.normal(size=(9, 5)), "ts")).collect()
    assert len(got) == 5 and all(r.value is None for r in got)


def cloud(spark, n=300):
    xyz = RNG.integers(-6, 6, size=(n, 3)) / 4 + (RNG.random((n, 1)) < 0.3) * RNG.normal(size=(n, 3))
    return xyz, spark.createDataFrame([(i, *[float(c) for c in p]) for i, p in enumerate(xyz)] + [(10_000, None, 0.0, 0.0)], "node_id long, x double, y double, z double")


@pytest.mark.parametrize("most", [4096, 20])
def test_near_sums_are_those_over_pairs(spark, most, monkeypatch):
    monkeypatch.setattr(blocks, "MOST", most)
    xyz, nodes = cloud(spark)
    y = RNG.normal(size=(300, 6))
    y[RNG.random(y.shape) < 0.2] = np.nan
    sources = nodes.join(spark.createDataFrame([(i, [None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(y)], "node_id long, v array<double>"), "node_id")
    got = {r.node_id: [np.nan if v is None else v for v in r.x] for r in blocks.near_means(sources.filter("node_id % 2 = 0"), sources, 0.5).collect()}
    # distances exactly at the bound count
    pairs = near_pairs(nodes.filter("node_id < 10000"), 0.5).filter("src % 2 = 0").toPandas()
    want = {i: np.nanmean(y[g["dst"].to_numpy()], 0) for i, g in pairs.groupby("src")}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], equal_nan=True) for i in want)
    smooth = blocks.gaussian_smooth(nodes.selectExpr("node_id", "y AS value").filter("node_id < 10000"), nodes, 0.5, 0.3).orderBy("node_id").collect()
    assert np.allclose([r.value for r in smooth], smoothed(xyz, xyz[:, 1], 0.5, 0.3))


def test_near_sums_have_no_row_for_a_pair(spark):
    _, nodes = cloud(spark)
    plan = blocks.gaussian_smooth(nodes.selectExpr("node_id", "y AS value"), nodes, 0.5, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("most", [4096, 5])
def test_sparse_product(spark, most, monkeypatch):
    monkeypatch.setattr(blocks, "MOST", most)
    y = RNG.normal(size=(50, 8))
    y[RNG.random(y.shape) < 0.3] = np.nan
    w = [(s, t, float(1 + s % 3)) for s in range(55) for t in range(30) if (s * 7 + t * 3) % 11 < 3 or t == 4]
    vectors = spark.createDataFrame([(i, [None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(y)], "node_id long, ts array<double>")
    got = {r.node_id: [np.nan if v is None else v for v in r.ts] for r in blocks.sparse_product(spark.createDataFrame(w, "src long, dst long, w double"), vectors, 7).collect()}
    for t in range(30):
        mine = [(s, c) for s, d, c in w if d == t and s < 50]
        top, bottom = sum(c * np.nan_to_num(y[s]) for s, c in mine), sum(c * ~np.isnan(y[s]) for s, c in mine)
        with np.errstate(invalid="ignore"):
            assert np.allclose(got[t], np.where(bottom > 0, top / bottom, np.nan), equal_nan=True)
