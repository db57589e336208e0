"""Embedding whitening against whole-number arithmetic in Python."""

import math
import random

import pytest

pytest.importorskip("loomframe.llm")
import numpy as np  # noqa: E402
from loomframe.llm import whitening as wh  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows):
    kept = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[j] for _, x in kept) for j in range(d)]
    scatter = [[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for _, x in kept) for j in range(d)] for i in range(d)]
    v = np.array([[s / n**3 for s in r] for r in scatter])
    return kept, n, sums, v


def check(got, rows):
    kept, n, sums, v = brute(rows)
    values = np.linalg.eigvalsh(v)[::-1]
    want = sorted((str(i), sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept)
    for k in range(1, min(8, len(sums)) + 1):
        mine = [r for r in got if r.component == k]
        assert sorted((str(r.vec_id), int(r.deviation_exact)) for r in mine) == want
        assert all(r.deviation == int(r.deviation_exact) for r in mine if int(r.deviation_exact) < 2**63)
        assert {r.n for r in mine} == {n}
        assert all(abs(r.explained - values[k - 1] / np.trace(v)) <= 1e-9 for r in mine)
    assert len(got) == n * min(8, len(sums))


def test_whitened_rows(spark, tmp_path):
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(12)]
    rows = [(i, [sum(b[k] * rng.gauss(0, 1) for k in range(5)) for b in base]) for i in range(400)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (900, None), (901, [1.0] * 11 + [None]), (902, [1.0] * 11 + [float("nan")]), (903, [float("inf")] + [0.0] * 11), (904, [1.0] * 3)]
    path = str(tmp_path)
    spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA + ", whitened string").repartition(5).write.parquet(f"{path}/embeddings.parquet")
    got = wh.op12_whitening(spark, path).collect()
    check(got, rows[:-1])
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-6
    kept, n, sums, v = brute(rows[:-1])
    sound = [k for k in range(1, 9) if any(r.component == k and r.whitened is not None for r in got)]
    assert sound[:5] == [1, 2, 3, 4, 5]
    w = np.array([[r.whitened for r in got if r.component == k] for k in sound])
    assert np.abs(w @ w.T / n - np.eye(len(sound))).max() < 1e-6
    # each component is an eigenvector: the covariance of the numbers with the whitened values is along it
    values, axes = np.linalg.eigh(v)
    fit = wh.fit_whitening(wh.usable(spark.createDataFrame(rows[:-1], SCHEMA)))
    for k in range(5):
        assert abs(abs(fit.axes[:, k] @ axes[:, ::-1][:, k]) - 1) < 1e-9


def test_cross_products_are_exact():
    rng = random.Random(1)
    for span in (0, 1, 5000, 2**40, 2**70):
        x = np.array([[rng.randint(-span, span) for _ in range(7)] for _ in range(130)], object)
        x = x.astype(np.int64) if span < 2**62 else x
        want = [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(7)] for i in range(7)]
        assert wh.cross_products(x).tolist() == want


def test_sums_do_not_depend_on_the_tasks(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-9, 9) * 10 ** rng.choice((-3, 0, 17)) for _ in range(3)]) for i in range(300)]
    fits = [wh.fit_whitening(spark.createDataFrame(rows, SCHEMA).repartition(p)) for p in (1, 7)]
    assert fits[0].sums == fits[1].sums == tuple(sum(math.floor(1024 * c) + 100_000 for c in v) for v in zip(*[r[1] for r in rows]))
    assert (fits[0].values == fits[1].values).all()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5]), (2, [0.5]), (3, [0.5])], [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])]])
def test_small_tables(spark, tmp_path, rows):
    path = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/embeddings.parquet")
    got = wh.op12_whitening(spark, path).collect()
    if not rows or not rows[0][1]:
        assert got == []
        return
    assert len(got) == len(rows) * len(rows[0][1])
    assert all((r.whitened is None) == (r.explained is None or r.explained < 1e-12) for r in got)


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], "a"), (2, [1.0, 5.0], "b")], "deviation long, _v array<double>, a string")
    out = wh.whiten(df, wh.fit_whitening(df, "_v"), "_v")
    assert out.columns == ["_v", "a", "whitened", "deviation", "deviation_exact"]
    assert {r.a for r in out.collect()} == {"a", "b"}
