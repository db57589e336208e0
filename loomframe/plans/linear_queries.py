"""Queries of regressions and fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from loomframe.operators import dual, stats
from loomframe.operators import linear as op

from loomframe.plans.adapters import echoes, nodes, r6, rounded, run_signal, signal, sql, vectors
from loomframe.plans.join_queries import _NEAR
from loomframe.plans.mask_queries import _MAPS
from loomframe.plans.registry import query
from loomframe.plans.stat_queries import R, component_maps

FRAMES = 28


def wide_signal(spark, d):
    return op.to_vectors(signal(spark, d), FRAMES)


def design(spark, d, k: int = 3) -> np.ndarray:
    """frames x k: mean series of the nodes by residue class, a small table."""
    rows = signal(spark, d).groupBy("frame", (F.col("node_id") % k).alias("c")).agg(F.avg("value").alias("v")).collect()
    x = np.zeros((FRAMES, k))
    for r in rows:
        x[r["frame"], r["c"]] = r["v"]
    return x - x.mean(0)


def long(df, digits: bool = True):
    return rounded(op.to_long(df), "value")


_GSR = f"SELECT node_id, frame, {R('value - b * gs - a + m', 'value')}, {R('b', 'slope')} FROM j JOIN (SELECT node_id, regr_slope(value, gs) AS b, regr_intercept(value, gs) AS a, avg(value) AS m FROM j GROUP BY 1) USING (node_id)"


@query("L1_global_signal_regression", sql("signal", _GSR, "g AS (SELECT frame, avg(value) AS gs FROM signal GROUP BY 1), j AS (SELECT * FROM signal JOIN g USING (frame))"))
def _(spark, d):
    return rounded(op.global_signal_regression(signal(spark, d)), "value", "slope")


@query("L2_mean_signal_regression", sql("signal", f"SELECT node_id, {R('b', 'beta')}, {R('b * b * vx', 'explained')}, {R('coalesce(b * b * vx / nullif(vy, 0), 0.0)', 'r2')} FROM (SELECT node_id, sum(x * y) / sum(x * x) AS b, var_samp(x) AS vx, var_samp(y) AS vy FROM j GROUP BY 1)", "g AS (SELECT frame, gs - avg(gs) OVER () AS x FROM (SELECT frame, avg(value) AS gs FROM signal GROUP BY 1)), j AS (SELECT node_id, x, y FROM (SELECT node_id, frame, value - avg(value) OVER (PARTITION BY node_id) AS y FROM signal) JOIN g USING (frame))"))
def _(spark, d):
    return rounded(op.mean_signal_regression(signal(spark, d)), "beta", "explained", "r2")


@query("L3_compartment_components")
def _(spark, d):
    basis, values = op.compartment_components(signal(spark, d), FRAMES, signal(spark, d).filter("node_id % 2 = 0"))
    # the projector doesn't depend on the vectors' signs
    return rounded(op.mixing_table(spark, basis @ basis.T), "value")


@query("L4_condition_design")
def _(spark, d):
    basis = op.condition_design(design(spark, d, 5))
    return rounded(op.mixing_table(spark, basis @ basis.T), "value")


@query("L5_nuisance_regression")
def _(spark, d):
    return long(op.nuisance_regression(wide_signal(spark, d), design(spark, d), np.arange(FRAMES) % 7 != 3))


@query("L6_extra_axial_mask", sql("signal", "SELECT node_id FROM signal GROUP BY 1 HAVING 100 * stddev_samp(value) / avg(value) > 12 AND node_id % 3 <> 0"))
def _(spark, d):
    s = signal(spark, d)
    return op.extra_axial_mask(stats.temporal_sd_percent(s), s.select("node_id").distinct().filter("node_id % 3 = 0"), 12.0)


@query("L7_variance_decomposition")
def _(spark, d):
    x = design(spark, d, 6)
    out = op.variance_decomposition(wide_signal(spark, d), x, [1, 4], x[:, :1] ** 2 / 1e4, op.highpass_matrix(FRAMES, 5.0))
    return rounded(out, *[c for c in out.columns if c != "node_id"])


@query("L8_regress_out")
def _(spark, d):
    return long(op.regress_out(wide_signal(spark, d), design(spark, d)))


@query("L9_remove_components")
def _(spark, d):
    return long(op.remove_components(wide_signal(spark, d), design(spark, d, 5), [0, 3]))


#: Every node's series without gaps (v), and the two classes' mean series without their means.
_TISSUE = f"""f AS (SELECT unnest(range({FRAMES}))::INTEGER AS frame),
full_ AS (SELECT n.node_id, f.frame, coalesce(s.value, 0)::DOUBLE AS v FROM (SELECT DISTINCT node_id FROM signal) n CROSS JOIN f LEFT JOIN signal s ON s.node_id = n.node_id AND s.frame = f.frame),
means AS (SELECT frame, avg(value) FILTER (node_id % 2 = 0) AS a, avg(value) FILTER (node_id % 2 = 1) AS b FROM signal GROUP BY 1),
x AS (SELECT f.frame, coalesce(a, 0) - avg(coalesce(a, 0)) OVER () AS a, coalesce(b, 0) - avg(coalesce(b, 0)) OVER () AS b FROM f LEFT JOIN means USING (frame)),
g AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM x),
y AS (SELECT node_id, count(*) * var_pop(v) AS vv, sum(a * v) AS av, sum(b * v) AS bv FROM full_ JOIN x USING (frame) GROUP BY 1)"""


@query("L10_tissue_signal_regression", sql("signal", f"SELECT node_id, {R('1 - (av * (bb * av - ab * bv) + bv * (aa * bv - ab * av)) / (aa * bb - ab * ab) / nullif(vv, 0)', 'ratio')} FROM y, g", _TISSUE))
def _(spark, d):
    x = design(spark, d, 2)
    return rounded(op.tissue_signal_regression(wide_signal(spark, d), x[:, 0], x[:, 1]).select("node_id", "ratio"), "ratio")


@query("L10_tissue_variances")
def _(spark, d):
    x, t = design(spark, d, 6), design(spark, d, 2)
    out = op.tissue_variances(wide_signal(spark, d), x, [1, 4], x[:, :1] ** 2 / 1e4, op.highpass_matrix(FRAMES, 5.0), t[:, 0], t[:, 1])
    return rounded(out, *[c for c in out.columns if c != "node_id"])


@query("L11_noise_sd_map")
def _(spark, d):
    return rounded(op.noise_sd_map(wide_signal(spark, d), design(spark, d, 5), [1, 2]), "sd")


@query("L12_component_beta_maps")
def _(spark, d):
    return rounded(op.component_beta_maps(wide_signal(spark, d), design(spark, d)), "loading")


def spatial_maps(spark, d):
    """component_id, node_id, loading: three indicator-like maps over the signal's nodes."""
    n = signal(spark, d).select("node_id").distinct()
    return n.select("node_id", F.posexplode(F.array((F.col("node_id") % 2).cast("double"), (F.col("node_id") % 3).cast("double"), F.lit(1.0))).alias("component_id", "loading"))


@query("L13_dual_regression")
def _(spark, d):
    return rounded(op.dual_regression(spatial_maps(spark, d), signal(spark, d), FRAMES), "loading")


def near_weights(spark, d, mm: float = 0.08, sigma: float = 0.05):
    return nodes(spark, d), mm, sigma


def likeness(spark, d, key):
    """node_id, a: each node's likeness (cosine) to the mean vector of every class of a key, in the order of keys. The classes are few."""
    v = vectors(spark, d).withColumn("_k", key)
    means = v.select("_k", F.posexplode("ts").alias("i", "x")).groupBy("_k", "i").agg(F.avg("x").alias("x"))
    wide = means.toPandas().pivot(index="_k", columns="i", values="x").sort_index().to_numpy()
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    return dual.map_blocks(v.select("node_id", "ts"), ["ts"], lambda y: unit(y) @ unit(wide).T, "a")


@query("L14_alignment_weights")
def _(spark, d):
    low = [likeness(spark, d, F.col("label_id")), likeness(spark, d, F.col("node_id") % 5)]
    n = nodes(spark, d)
    areas = n.select("node_id", (F.abs("x") + 0.5).alias("w"))
    fit, weights = dual.reweighted_dual_regression(vectors(spark, d), low, likeness(spark, d, F.col("label_id") * 2 + F.col("node_id") % 2), n, 0.08, 0.05, areas)
    out = fit.maps.join(weights, "node_id").select("node_id", r6("w").alias("w"), F.posexplode("b").alias("component_id", "loading"))
    return rounded(out, "loading")


@query("L15_vn_concat", sql("run_signal", f"SELECT run, node_id, frame, {R('(value - m) / greatest(coalesce(s, 0) / a, 0.001)', 'value')} FROM run_signal JOIN (SELECT *, avg(s) OVER (PARTITION BY run) AS a FROM (SELECT run, node_id, avg(value) AS m, stddev_samp(value) AS s FROM run_signal GROUP BY 1, 2)) USING (run, node_id)"))
def _(spark, d):
    return rounded(op.vn_concat(run_signal(spark, d)), "value")


_VN = "vn AS (SELECT run, node_id, m, greatest(coalesce(s, 0) / avg(s) OVER (PARTITION BY run), 0.001) AS vn FROM (SELECT run, node_id, avg(value) AS m, stddev_samp(value) AS s FROM run_signal GROUP BY 1, 2)), c AS (SELECT run, node_id, frame, (value - m) / vn AS v FROM run_signal JOIN vn USING (run, node_id)), x AS (SELECT run, frame, avg(v) AS x FROM c GROUP BY 1, 2)"


@query("L15_restored_betas", sql("run_signal", f"SELECT node_id, {R('b * vn', 'loading')} FROM (SELECT node_id, regr_slope(v, x) AS b FROM c JOIN x USING (run, frame) GROUP BY 1) JOIN (SELECT node_id, avg(vn) AS vn FROM vn GROUP BY 1) USING (node_id)", _VN))
def _(spark, d):
    s = run_signal(spark, d)
    concat = op.vn_concat(s)
    level = concat.groupBy("run", "frame").agg(F.avg("value").alias("x"))
    betas = concat.join(level, ["run", "frame"]).groupBy("node_id").agg(F.regr_slope("value", "x").alias("loading"))
    return rounded(op.restored_betas(betas, s), "loading")


@query("L16_beta_z")
def _(spark, d):
    return rounded(op.beta_z(wide_signal(spark, d), design(spark, d)), "beta", "z")


@query("L17_normalise_to_input", sql("vectors", f"SELECT component_id, node_id, {R('(l - avg(l) OVER w) / stddev_samp(l) OVER w * stddev_samp(loading) OVER w + avg(loading) OVER w', 'loading')} FROM (SELECT component_id, node_id, loading, loading * (1 + node_id % 3) AS l FROM maps) WINDOW w AS (PARTITION BY component_id)", _MAPS))
def _(spark, d):
    m = component_maps(spark, d)
    return rounded(op.normalise_to_input(m.withColumn("loading", F.col("loading") * (1 + F.col("node_id") % 3)), m), "loading")


@query("L18_pca_dimensionality")
def _(spark, d):
    return rounded(op.pca_dimensionality(signal(spark, d), FRAMES), "laplace", "bic", "aic", "mdl")


@query("L19_variance_normalise")
def _(spark, d):
    return long(op.variance_normalise(signal(spark, d), FRAMES, 3))


@query("W10_poly_detrend")
def _(spark, d):
    return long(op.poly_detrend(wide_signal(spark, d), FRAMES, 2))


@query("W11_gaussian_highpass")
def _(spark, d):
    return long(op.gaussian_highpass(wide_signal(spark, d), FRAMES, 5.0))


#: Near pairs of L24 by cells, so that SQL doesn't compare all nodes; each step is kept.
_L24 = """cell AS MATERIALIZED (SELECT node_id, label_id, x, y, z, floor(x / 0.08)::INTEGER AS cx, floor(y / 0.08)::INTEGER AS cy, floor(z / 0.08)::INTEGER AS cz FROM nodes),
step AS (SELECT unnest([-1, 0, 1]) AS o),
pair AS MATERIALIZED (SELECT a.node_id AS src, b.node_id AS dst FROM (SELECT * FROM cell WHERE label_id >= 4) a CROSS JOIN step i CROSS JOIN step j CROSS JOIN step k JOIN cell b ON b.cx = a.cx + i.o AND b.cy = a.cy + j.o AND b.cz = a.cz + k.o WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 0.08),
s AS MATERIALIZED (SELECT node_id, unnest(range(0, 64)) AS frame, unnest(ts) AS value FROM vectors),
x AS MATERIALIZED (SELECT src AS node_id, frame, avg(value) AS x FROM pair JOIN s ON s.node_id = dst GROUP BY 1, 2),
j AS MATERIALIZED (SELECT node_id, frame, value, x FROM s JOIN x USING (node_id, frame)),
f AS (SELECT node_id, coalesce(regr_slope(value, x), 0) AS b, avg(value) AS my, avg(x) AS mx FROM j GROUP BY 1)"""


@query("L24_near_signal_regression", sql("vectors nodes", f"SELECT node_id, frame, {R('value - my - b * (x - mx)', 'value')} FROM j JOIN f USING (node_id) UNION ALL SELECT node_id, frame, {R('value', 'value')} FROM s JOIN nodes USING (node_id) WHERE label_id < 4", _L24))
def _(spark, d):
    n = nodes(spark, d).withColumn("is_cortex", F.col("label_id") < 4)
    return long(op.near_signal_regression(vectors(spark, d), n, 0.08))


#: Centred unit vectors, and those of the first ten nodes as references.
_UNIT = """c AS (SELECT node_id, list_transform(ts, lambda e: e - m) AS c FROM (SELECT *, list_avg(ts) AS m FROM vectors)),
u AS (SELECT node_id, list_transform(c, lambda e: e / n) AS u FROM (SELECT *, sqrt(list_dot_product(c, c)) + 1e-8 AS n FROM c)),
r AS (SELECT (row_number() OVER (ORDER BY node_id) - 1)::INTEGER AS ref, u AS r FROM u ORDER BY node_id LIMIT 10),
p AS (SELECT node_id, ref, list_dot_product(u, r) AS v FROM u, r)"""


@query("L26_fc_fingerprints", sql("vectors", f"SELECT node_id, ref, {R('v / (sqrt(sum(v * v) OVER (PARTITION BY node_id)) + 1e-8)', 'value')} FROM p", _UNIT))
def _(spark, d):
    v = vectors(spark, d)
    refs = np.array([r["ts"] for r in v.orderBy("node_id").limit(10).collect()])
    return rounded(op.fc_fingerprints(v, refs).select("node_id", F.posexplode("fp").alias("ref", "value")), "value")


@query("L27_map_regression", sql("nodes", f"SELECT node_id, {R('x - (SELECT regr_intercept(x, y) FROM nodes) - (SELECT regr_slope(x, y) FROM nodes) * y', 'x')} FROM nodes"))
def _(spark, d):
    return rounded(op.map_regression(nodes(spark, d).select("node_id", "x", "y"), "x", "y").select("node_id", "x"), "x")


_W = _NEAR.format(0.08) + ", w AS (SELECT src, dst, exp(-dist * dist / (2 * 0.05 * 0.05)) AS w FROM near)"
_SMOOTH = "(SELECT src AS node_id, sum(w * {0}) / sum(w) AS {1} FROM w JOIN {2} ON node_id = dst GROUP BY 1)"


@query("G14_smooth", sql("nodes", f"SELECT node_id, {R('v', 'value')} FROM {_SMOOTH.format('x', 'v', 'nodes')}", _W))
def _(spark, d):
    return rounded(op.smooth(nodes(spark, d).select("node_id", F.col("x").alias("value")), near_weights(spark, d)), "value")


@query("G14_smooth_masked", sql("nodes", f"SELECT node_id, {R('v', 'value')} FROM {_SMOOTH.format('x', 'v', '(SELECT * FROM nodes WHERE label_id < 6)')}", _W))
def _(spark, d):
    n = nodes(spark, d)
    return rounded(op.smooth(n.select("node_id", F.col("x").alias("value")), near_weights(spark, d), n.filter("label_id < 6")), "value")


@query("L28_reference_bias", sql("nodes", f"SELECT node_id, {R('x - a + b', 'value')} FROM nodes JOIN {_SMOOTH.format('x', 'a', 'nodes')} USING (node_id) JOIN {_SMOOTH.format('y', 'b', 'nodes')} USING (node_id)", _W))
def _(spark, d):
    n = nodes(spark, d)
    return rounded(op.reference_bias(n.select("node_id", F.col("x").alias("value")), n.select("node_id", F.col("y").alias("value")), near_weights(spark, d)), "value")


@query("L29_bias_field", sql("nodes", f"SELECT node_id, {R('v', 'value')} FROM q WHERE v >= (SELECT avg(v) - stddev_samp(v) / 2 FROM q)", _W + f", p AS (SELECT node_id, v / avg(v) OVER () AS v FROM (SELECT node_id, sqrt(abs(x * y)) AS v FROM nodes)), q AS (SELECT node_id, v / s AS v FROM p JOIN {_SMOOTH.format('v', 's', 'p')} USING (node_id))"))
def _(spark, d):
    n = nodes(spark, d)
    return rounded(op.bias_field(n.select("node_id", F.col("x").alias("value")), n.select("node_id", F.col("y").alias("value")), near_weights(spark, d)), "value")


@query("L30_mass_univariate_glm")
def _(spark, d):
    x = design(spark, d)
    return rounded(op.mass_univariate_glm(wide_signal(spark, d), x, np.array([[1, 0, 0], [1, -1, 0]])), "cope", "varcope", "t", "z")


@query("L31_fixed_effects", sql("run_signal", f"SELECT 0 AS contrast, node_id, {R('sum(m / v) / sum(1 / v)', 'cope')}, {R('1 / sum(1 / v)', 'varcope')}, sum(n)::BIGINT AS dof FROM (SELECT run, node_id, avg(value) AS m, var_samp(value) AS v, count(*) - 1 AS n FROM run_signal GROUP BY 1, 2) WHERE v > 0 GROUP BY 2 HAVING count(*) = 3"))
def _(spark, d):
    c = run_signal(spark, d).groupBy("run", "node_id").agg(F.avg("value").alias("cope"), F.var_samp("value").alias("varcope"), (F.count(F.lit(1)) - 1).alias("dof")).withColumn("contrast", F.lit(0))
    return rounded(op.fixed_effects(c, 3), "cope", "varcope")


_T2 = "f AS (SELECT node_id, regr_slope(ln(value), -te) AS r, regr_intercept(ln(value), -te) AS a FROM echoes WHERE value > 0 GROUP BY 1), t AS (SELECT node_id, exp(a) AS s0, CASE WHEN r > 0 THEN 1 / r END AS t2s FROM f)"


@query("L32_t2star_fit", sql("echoes", f"SELECT node_id, {R('ln(s0)', 'ln_s0')}, {R('1 / t2s', 'rate')} FROM t", _T2))
def _(spark, d):
    return op.t2star_fit(echoes(spark, d)).select("node_id", r6(F.log("s0")).alias("ln_s0"), r6(1 / F.col("t2s")).alias("rate"))


@query("L33_optimal_combination", sql("echoes", f"SELECT node_id, {R('sum(te * exp(-te / t2s) * value) / sum(te * exp(-te / t2s))', 'value')} FROM echoes JOIN t USING (node_id) WHERE t2s IS NOT NULL GROUP BY 1", _T2))
def _(spark, d):
    e = echoes(spark, d)
    return rounded(op.optimal_combination(e, op.t2star_fit(e)), "value")


@query("L34_exclusive_regression")
def _(spark, d):
    return rounded(dual.exclusive_regression(spatial_maps(spark, d), wide_signal(spark, d)), "value")
