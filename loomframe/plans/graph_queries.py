"""Queries of graphs, parcels and network mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import graph as op
from loomframe.operators import mapping
from loomframe.operators.communities import density_communities
from loomframe.operators.connectivity import density_connectivity, topk_connectivity
from loomframe.plans.adapters import nodes, r6, rounded, sql, table, vectors
from loomframe.plans.join_queries import _ADJ, _FC, _NEAR, adjacency, priors
from loomframe.plans.registry import query
from loomframe.plans.stat_queries import R

_TOP = "top AS (SELECT src, dst, fc FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY fc DESC, dst) AS k FROM fc WHERE fc > 0) WHERE k <= (SELECT greatest(ceil(count(*) * {0}::DOUBLE), 1) FROM vectors))"


def series(spark, d):
    """node_id, ts as the table has them: floats, half the size of vectors."""
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("node_id"), F.col("embedding").alias("ts"))


@query("T1_topk_edges", sql("vectors", f"SELECT src, dst, {R('max(fc)', 'w')} FROM (SELECT src, dst, fc FROM top UNION ALL SELECT dst, src, fc FROM top) GROUP BY 1, 2", _FC + ", " + _TOP.format(0.01)))
def _(spark, d):
    return rounded(topk_connectivity(series(spark, d), 0.01), "w")


@query("G1_density_graphs", sql("vectors", f"SELECT density, least(src, dst) AS src, greatest(src, dst) AS dst, {R('max(fc)', 'w')} FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY fc DESC, dst) AS k FROM fc WHERE fc > 0) JOIN (SELECT density, greatest(ceil((SELECT count(*) FROM vectors) * density), 1) AS most FROM (VALUES (0.004::DOUBLE), (0.01::DOUBLE)) v(density)) ON k <= most GROUP BY 1, 2, 3", _FC))
def _(spark, d):
    return rounded(density_connectivity(series(spark, d), [0.004, 0.01]), "w")


DENSITIES = [k / 1000 for k in range(1, 10)]


@query("G2_communities")
def _(spark, d):
    return density_communities(series(spark, d), DENSITIES)


@query("G3_drop_small", sql("nodes", "SELECT density, node_id, CASE WHEN count(*) OVER (PARTITION BY density, community) < 6 THEN 0 ELSE community END AS community FROM (SELECT label_id AS density, node_id, i + 20 AS community FROM nodes)"))
def _(spark, d):
    return op.drop_small(nodes(spark, d).select(F.col("label_id").alias("density"), "node_id", (F.col("i") + 20).alias("community")), 6)


def labels(spark, d):
    return nodes(spark, d).select("node_id", (F.col("node_id") % 4).cast("int").alias("label_id"))


_LABELS = "lab AS (SELECT node_id, (node_id % 4)::INTEGER AS label_id FROM nodes)"


@query("G4_connected_patches", "WITH RECURSIVE " + sql("nodes", "SELECT n.node_id, n.label_id, coalesce(min(p.m), n.node_id) AS patch FROM lab n LEFT JOIN p ON p.node_id = n.node_id WHERE n.label_id > 0 GROUP BY 1, 2", _ADJ + ", " + _LABELS + ", e AS (SELECT src, dst FROM adj JOIN lab a ON a.node_id = src JOIN lab b ON b.node_id = dst WHERE a.label_id = b.label_id AND a.label_id > 0), p(node_id, m) AS (SELECT node_id, node_id FROM lab WHERE label_id > 0 UNION SELECT e.dst, p.m FROM p JOIN e ON e.src = p.node_id)")[len("WITH "):])
def _(spark, d):
    return op.connected_patches(labels(spark, d), adjacency(spark, d))


_VOTE = "v AS (SELECT src AS node_id, arg_max(label_id, n * 1000 - label_id) AS vote FROM (SELECT src, label_id, count(*) AS n FROM adj JOIN lab ON node_id = dst WHERE label_id > 0 GROUP BY 1, 2) GROUP BY 1)"


@query("G5_majority_smooth", sql("nodes", "SELECT node_id, coalesce(vote, label_id) AS label_id FROM lab LEFT JOIN v USING (node_id)", _ADJ + ", " + _LABELS + ", " + _VOTE))
def _(spark, d):
    return op.majority_smooth(labels(spark, d), adjacency(spark, d))


@query("G6_prune_small_patches")
def _(spark, d):
    return op.prune_small_patches(labels(spark, d), adjacency(spark, d), 5)


@query("G7_k_bounds", sql("nodes", "SELECT label_id AS patch, k::INTEGER AS k_max, greatest(1, floor(k / 4))::INTEGER AS window FROM (SELECT label_id, greatest(1, least(8, floor(count(*) / 9.0), floor(sum(abs(x)) / 0.9))) AS k FROM nodes GROUP BY 1)"))
def _(spark, d):
    return op.k_bounds(nodes(spark, d).select(F.col("label_id").alias("patch"), F.abs("x").alias("area")), 8, 9, 0.9)


def parts(spark, d):
    patches = op.connected_patches(labels(spark, d).withColumn("label_id", F.col("label_id") % 2 + 1), adjacency(spark, d)).select("node_id", "patch")
    v = vectors(spark, d).select("node_id", "ts").join(patches, "node_id")
    return op.split_patch(v, op.k_bounds(v.withColumn("area", F.lit(1.0)), 4, 8, 1.0), adjacency(spark, d), 4)


@query("G8_split_patch")
def _(spark, d):
    return parts(spark, d).select("patch", "node_id", "part")


@query("G9_choose_k")
def _(spark, d):
    return parts(spark, d).select("patch", "k", r6("contrast").alias("contrast")).distinct()


@query("G10_diffuse_labels")
def _(spark, d):
    return op.diffuse_labels(parts(spark, d), adjacency(spark, d))


@query("G11_dilate", sql("nodes", "SELECT DISTINCT node_id FROM (SELECT node_id FROM nodes WHERE node_id % 5 = 0 UNION ALL SELECT src FROM adj WHERE dst % 5 = 0)", _ADJ))
def _(spark, d):
    return op.dilate(nodes(spark, d).filter("node_id % 5 = 0").select("node_id"), adjacency(spark, d))


@query("G11_erode", sql("nodes", "SELECT node_id FROM nodes WHERE node_id % 5 > 0 AND node_id NOT IN (SELECT src FROM adj WHERE dst % 5 = 0)", _ADJ))
def _(spark, d):
    return op.erode(nodes(spark, d).filter("node_id % 5 > 0").select("node_id"), adjacency(spark, d))


_UNIT = "un AS (SELECT node_id, list_transform(ts, lambda v: v / sqrt(list_dot_product(ts, ts))) AS ts FROM vectors)"
_GRADIENT = _UNIT + ", sim AS (SELECT n.node_id, coalesce(avg(list_dot_product(a.ts, b.ts)), 0.0) AS g FROM un n LEFT JOIN adj ON src = n.node_id LEFT JOIN un a ON a.node_id = src LEFT JOIN un b ON b.node_id = dst GROUP BY 1)"


def unit(spark, d):
    norm = F.sqrt(F.aggregate("ts", F.lit(0.0), lambda s, v: s + v * v))
    v = vectors(spark, d).withColumn("n", norm)
    return v.select("node_id", F.transform("ts", lambda x: x / F.col("n")).alias("ts"))


@query("G13_local_gradient", sql("vectors nodes", f"SELECT node_id, {R('(g - (SELECT min(g) FROM sim)) / ((SELECT max(g) FROM sim) - (SELECT min(g) FROM sim) + 1e-8)', 'value')} FROM sim", _ADJ + ", " + _GRADIENT))
def _(spark, d):
    return rounded(op.local_gradient(unit(spark, d), adjacency(spark, d)), "value")


@query("G12_merge_parcels")
def _(spark, d):
    p = nodes(spark, d).select("node_id", (F.col("label_id") * 100 + F.col("i") + 20).cast("long").alias("parcel"))
    return op.merge_parcels(p, adjacency(spark, d), op.local_gradient(unit(spark, d), adjacency(spark, d)), 4, 0.2)


@query("G15_fill_nearest", sql("nodes", f"SELECT n.node_id, {R('coalesce(v, f)', 'value')} FROM (SELECT node_id, CASE WHEN node_id % 3 > 0 THEN x END AS v FROM nodes) n LEFT JOIN (SELECT src, arg_min(x, d) AS f FROM (SELECT src, x, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS d FROM near JOIN nodes ON node_id = dst WHERE dst % 3 > 0) GROUP BY 1) ON src = n.node_id", _NEAR.format(0.08)))
def _(spark, d):
    n = nodes(spark, d)
    return rounded(op.fill_near(n.select("node_id", F.when(F.col("node_id") % 3 > 0, F.col("x")).alias("value")), n, 0.08), "value")


@query("G16_boundary_edges", sql("nodes", "SELECT src, dst FROM adj WHERE src < dst AND src % 4 <> dst % 4", _ADJ))
def _(spark, d):
    return op.boundary_edges(labels(spark, d), adjacency(spark, d))


@query("G17_largest_component", "WITH RECURSIVE " + sql("nodes", "SELECT node_id FROM q WHERE m = (SELECT m FROM q GROUP BY 1 ORDER BY count(*) DESC, m LIMIT 1)", _ADJ + ", p(node_id, m) AS (SELECT node_id, node_id FROM nodes WHERE node_id % 3 > 0 UNION SELECT dst, m FROM p JOIN adj ON src = p.node_id WHERE dst % 3 > 0), q AS (SELECT node_id, min(m) AS m FROM p GROUP BY 1)")[len("WITH "):])
def _(spark, d):
    return op.largest_component(nodes(spark, d).filter("node_id % 3 > 0"), adjacency(spark, d))


@query("G18_assign_parcels", sql("nodes", "SELECT node_id, parcel, n_name || '_' || row_number AS name FROM pt JOIN (SELECT parcel, n_name, row_number() OVER (PARTITION BY m ORDER BY parcel) AS row_number FROM (SELECT parcel, arg_max(l, n * 1000 - l) AS m FROM (SELECT parcel, node_id % 4 AS l, count(*) AS n FROM pt GROUP BY 1, 2) GROUP BY 1) JOIN nation ON n_nationkey = m) USING (parcel)", "pt AS (SELECT node_id, dense_rank() OVER (ORDER BY label_id, i)::INTEGER AS parcel FROM nodes)"))
def _(spark, d):
    p = nodes(spark, d).select("node_id", F.col("label_id").alias("patch"), F.col("i").alias("part"))
    networks = table(spark, d, "nation").select(F.col("n_nationkey").alias("network_id"), F.col("n_name").alias("name"))
    return op.assign_parcels(p, labels(spark, d), networks)


@query("T5_spaced_reference")
def _(spark, d):
    return op.spaced_reference(nodes(spark, d), 0.12)


@query("T5_spread_reference")
def _(spark, d):
    return op.spaced_reference(nodes(spark, d), 0.12, most=40)


def spatial_priors(spark, d):
    own = vectors(spark, d).select("node_id", "label_id")
    return priors(spark, d).join(own, "node_id").select("node_id", "network_id", "fc", F.when(F.col("label_id") == F.col("network_id"), 0.9).otherwise(0.2).alias("spatial"))


@query("L25_ridge_fusion")
def _(spark, d):
    return rounded(mapping.ridge_fusion(vectors(spark, d), spatial_priors(spark, d)), "beta", "p", "r2")


@query("J9_local_exclusion")
def _(spark, d):
    return rounded(mapping.ridge_fusion(vectors(spark, d), spatial_priors(spark, d), (nodes(spark, d), 0.1)), "beta", "p", "r2")
