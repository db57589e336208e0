"""Component decisions against the rules as a loop over rows."""

import math
import random

import numpy as np
import pytest

from loomframe.operators import components as op

EPS = np.finfo(float).eps
SCHEMA = "component_id long, kappa double, rho double, r2 double, ratio double, variance_explained double, keep boolean"


def table(seed, n=60):
    rng = random.Random(seed)
    odd = lambda v: rng.choice([v] * 8 + [math.nan, None])
    return [(i, odd(rng.choice((1.0, 2.0, rng.uniform(0.1, 60)))), odd(rng.choice((1.0, 0.0, rng.uniform(0, 40)))), odd(rng.choice((0.01, 0.05, 0.2, rng.uniform(0, 0.4)))), odd(rng.choice((5.0, 1.0, 9.0))), odd(rng.choice((1.0, 1.0, rng.uniform(0, 3)))), rng.choice((True, True, False, None))) for i in range(n)]


def number(v):
    return math.nan if v is None else v


def decide(rows, guardrail, kill, priority):
    kappa, rho, s, ratio, v = (np.array([number(r[k]) for r in rows]) for k in range(1, 6))
    with np.errstate(invalid="ignore"):
        ahead = kappa > rho
    initial = np.array([bool(r[6]) for r in rows]) & (ahead if guardrail else True)
    known = s[initial & np.isfinite(s)]
    floor = np.quantile(known, 0.1) if known.size else np.inf
    rescued, cand = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    for i in range(len(rows)):
        if not np.isfinite(s[i]):
            continue
        rescued[i] = not initial[i] and s[i] >= 0.2 and s[i] >= floor and (ahead[i] or not guardrail)
        with np.errstate(invalid="ignore"):
            limit = kill if kill is not None else np.clip(0.1 - 0.5 * np.log10(kappa[i] / np.maximum(rho[i], EPS) + EPS), 0.02, 0.1)
        cand[i] = initial[i] and s[i] < limit and not (np.isfinite(ratio[i]) and ahead[i] and ratio[i] >= 5)
    killed = cand.copy()
    if priority and cand.any():
        v = np.where(np.isfinite(v), v, 0)
        at = np.flatnonzero(cand)
        at = at[v[at] >= np.quantile(v[at], 0.6)]
        z = lambda a: (a - a.mean()) / a.std() if a.std() > 0 else np.zeros(len(a))
        score = -0.5 * z(np.log10(kappa[at] / np.maximum(rho[at], EPS) + EPS)) - 0.3 * z(s[at]) + 0.2 * z(v[at])
        at = at[np.argsort(-np.round(score, 12), kind="stable")]
        total, killed[:] = v[at].sum(), False
        n = len(at) if total <= 0 else min(len(at), int((np.cumsum(v[at]) <= 0.95 * total).sum()) + 1)
        killed[at[:n]] = True
    keep = (initial | rescued) & ~killed & (ahead if guardrail else True)
    return [(r[0], *map(bool, x)) for r, x in zip(rows, zip(initial, keep, rescued, killed, cand))]


@pytest.mark.parametrize("guardrail,kill,priority", [(True, None, True), (True, 0.06, False), (False, None, False), (False, 0.3, True)])
def test_rules(spark, guardrail, kill, priority):
    for seed in (1, 2):
        rows = table(seed)
        df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", note string")
        got = op.refine_components(df, kill=kill, guardrail=guardrail, priority=op.KillPriority() if priority else None)
        assert got.columns[: len(df.columns)] == df.columns
        assert sorted((r.component_id, r.initial, r.keep, r.rescued, r.killed, r.kill_candidate) for r in got.collect()) == decide(rows, guardrail, kill, priority)


def test_manual_ids_come_last_and_nothing_kept(spark):
    rows = [(1, 2.0, 1.0, 0.3, None, 1.0, False), (2, 2.0, 1.0, math.nan, None, 1.0, True), (3, 1.0, 2.0, 0.9, None, 1.0, True)]
    ids = lambda *i: spark.createDataFrame([(x,) for x in i], "component_id long")
    got = {r.component_id: r.keep for r in op.refine_components(spark.createDataFrame(rows, SCHEMA), accept=ids(3, 1), reject=ids(1)).collect()}
    # nothing initial has a score, so nothing is rescued; a score that is not a number leaves a kept one alone
    assert got == {1: False, 2: True, 3: True}
    assert op.refine_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_priorities_of_any_order(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(k), float(r), float(s), float(v)) for i, (k, r, s, v) in enumerate(zip(*rng.lognormal(0, 2, (4, 5000))))]
    table = lambda some, n: spark.createDataFrame(some, "component_id long, kappa double, rho double, r2 double, variance_explained double").repartition(n)
    one, other = (sorted(map(tuple, op.rank_kill_candidates(t).collect())) for t in (table(rows, 1), table(rows[::-1], 7)))
    assert one == other
    x = np.array(rows)
    z = lambda v: (v - v.mean()) / v.std()
    assert np.allclose([r[-2] for r in one], -z(np.log10(x[:, 1] / x[:, 2] + 1e-8)) - z(x[:, 3]) + z(x[:, 4]), atol=1e-12)
