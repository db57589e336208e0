"""Queries of regressions over many runs in one plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import runs as op
from loomframe.plans.adapters import rounded, run_signal, sql
from loomframe.plans.registry import query
from loomframe.plans.stat_queries import R


def run_vectors(spark, d):
    return op.run_vectors(run_signal(spark, d))


def class_means(spark, d, k: int):
    """run, frame (from 0), column, value: the mean series of the nodes by residue class in each run."""
    s = run_signal(spark, d)
    first = F.broadcast(s.groupBy("run").agg(F.min("frame").alias("_f")))
    return s.join(first, "run").groupBy("run", (F.col("frame") - F.col("_f")).cast("int").alias("frame"), (F.col("node_id") % k).cast("int").alias("column")).agg(F.avg("value").alias("value"))


def design(spark, d, k: int, name: str = "design"):
    return op.packed(class_means(spark, d, k), name)


def long(df):
    return rounded(df.select("run", "node_id", F.posexplode("ts").alias("frame", "value")), "value")


#: full: every node's series in each run without gaps (v), with one regressor (x) or two (a, b).
_FULL = """f AS (SELECT run, unnest(range(min(frame), max(frame) + 1)) AS t, min(frame) AS f0 FROM run_signal GROUP BY run),
mean1 AS (SELECT run, frame, avg(value) AS x FROM run_signal GROUP BY 1, 2),
mean2 AS (SELECT run, frame, avg(value) FILTER (node_id % 2 = 0) AS a, avg(value) FILTER (node_id % 2 = 1) AS b FROM run_signal GROUP BY 1, 2),
full_ AS (SELECT n.run, n.node_id, (t - f0)::INTEGER AS frame, coalesce(value, 0) AS v, x, a, b FROM (SELECT DISTINCT run, node_id FROM run_signal) n JOIN f ON f.run = n.run LEFT JOIN run_signal s ON s.run = n.run AND s.node_id = n.node_id AND s.frame = t JOIN mean1 m ON m.run = n.run AND m.frame = t JOIN mean2 k ON k.run = n.run AND k.frame = t)"""


@query("L3_compartment_components_runs")
def _(spark, d):
    v = run_vectors(spark, d)
    basis = op.unpacked(op.compartment_components(v, v.filter("node_id % 2 = 0"), 4.0), "basis")
    # the projector doesn't depend on the vectors' signs
    other = basis.select("run", F.col("frame").alias("other"), "column", F.col("value").alias("v"))
    return rounded(basis.join(other, ["run", "column"]).groupBy("run", "frame", "other").agg(F.sum(F.col("value") * F.col("v")).alias("value")), "value")


@query("L4_condition_designs", sql("run_signal", f"SELECT p.run, p.frame, q.frame AS other, {R('p.z * q.z / s', 'value')} FROM z p JOIN z q USING (run) JOIN (SELECT run, sum(z * z) AS s FROM z GROUP BY 1) USING (run)", _FULL + ", z AS (SELECT run, (frame - min(frame) OVER w)::INTEGER AS frame, x - avg(x) OVER w AS z FROM mean1 WINDOW w AS (PARTITION BY run))"))
def _(spark, d):
    basis = op.unpacked(op.condition_designs(design(spark, d, 1)), "basis")
    other = basis.select("run", F.col("frame").alias("other"), "column", F.col("value").alias("v"))
    return rounded(basis.join(other, ["run", "column"]).select("run", "frame", "other", (F.col("value") * F.col("v")).alias("value")), "value")


@query("L5_nuisance_regression_runs", sql("run_signal", f"SELECT run, node_id, frame, {R('v - s * (x - avg(x) OVER (PARTITION BY run, node_id))', 'value')} FROM full_ JOIN (SELECT run, node_id, regr_slope(v, x) AS s FROM full_ WHERE frame % 4 <> 3 GROUP BY 1, 2) USING (run, node_id)", _FULL))
def _(spark, d):
    keep = class_means(spark, d, 1).select("run", "frame", (F.col("frame") % 4 != 3).alias("keep"))
    return long(op.nuisance_regression(run_vectors(spark, d), design(spark, d, 1), keep))


@query("L5_denoise_runs")
def _(spark, d):
    v = run_vectors(spark, d)
    ids = v.select("run", "node_id")
    keep = class_means(spark, d, 1).select("run", "frame", (F.col("frame") % 5 != 2).alias("keep"))
    done = op.denoise(v, [ids.filter("node_id % 3 = 0"), ids.filter("node_id % 3 = 1")], ids.filter("node_id % 2 = 0"), class_means(spark, d, 2), ids.filter("node_id % 7 > 0"), keep, 3.0, 30.0)
    return long(done)


@query("L7_variance_decomposition_runs")
def _(spark, d):
    noise = class_means(spark, d, 3).filter("column > 0").select("run", F.col("column").alias("component_id")).distinct()
    out = op.variance_decomposition(run_vectors(spark, d), design(spark, d, 3, "mixing"), noise, design(spark, d, 2, "motion"), 3.0)
    return rounded(out, *op.STAGES)


@query("L8_regress_out_runs", sql("run_signal", f"SELECT run, node_id, frame, {R('v - x * sum(v * x) OVER w / sum(x * x) OVER w', 'value')} FROM full_ WINDOW w AS (PARTITION BY run, node_id)", _FULL))
def _(spark, d):
    return long(op.regress_out(run_vectors(spark, d), design(spark, d, 1)))


@query("L9_remove_components_runs", sql("run_signal", f"SELECT run, node_id, frame, {R('v - b * (aa * bv - ab * av) / (aa * bb - ab * ab)', 'value')} FROM full_ JOIN (SELECT run, node_id, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * v) AS av, sum(b * v) AS bv FROM full_ GROUP BY 1, 2) USING (run, node_id)", _FULL))
def _(spark, d):
    noise = class_means(spark, d, 1).select("run", F.lit(1).alias("component_id")).distinct()
    return long(op.remove_components(run_vectors(spark, d), design(spark, d, 2, "mixing"), noise))


@query("L12_component_beta_maps_runs", sql("run_signal", f"SELECT run, node_id, 0 AS component_id, {R('regr_slope(v, x)', 'loading')} FROM full_ GROUP BY 1, 2", _FULL))
def _(spark, d):
    return rounded(op.component_beta_maps(run_vectors(spark, d), design(spark, d, 1, "mixing")), "loading")
