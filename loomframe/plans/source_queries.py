"""Queries of readers and manifests: what they make of text columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators.joins import near_pairs
from loomframe.operators.masks import classify_series
from loomframe.plans.adapters import nodes, rounded, signal, sql, table
from loomframe.plans.join_queries import _NEAR
from loomframe.plans.mask_queries import REASON_SQL, SERIES_SQL, URL_RULES
from loomframe.plans.registry import query
from loomframe.sources import readers, sinks


@query("S1_read_signal", "SELECT l_linenumber % 2 AS run, l_suppkey AS node_id, l_orderkey AS frame, l_quantity AS value FROM lineitem WHERE l_linenumber % 2 = 1")
def _(spark, d):
    t = table(spark, d, "lineitem").select((F.col("l_linenumber") % 2).alias("run"), F.col("l_suppkey").alias("node_id"), F.col("l_orderkey").alias("frame"), F.col("l_quantity").alias("value"))
    return readers.nan_to_null(readers.require_columns(t, ["run", "node_id", "frame", "value"])).filter(F.col("run").isin([1]))


@query("S2_list_runs", "SELECT o_orderkey, (o_custkey % 5)::INTEGER AS session, (o_orderkey % 4)::INTEGER AS run FROM orders WHERE o_custkey % 5 >= 2")
def _(spark, d):
    path = F.concat(F.lit("/data/session_"), F.col("o_custkey") % 5, F.lit("/run_"), F.col("o_orderkey") % 4, F.lit("/x.nii.gz"))
    return readers.runs_of_paths(table(spark, d, "orders").select("o_orderkey", path.alias("path")), 2).select("o_orderkey", "session", "run")


@query("S3_read_sidecars", "SELECT event_id AS path, coalesce(CASE WHEN event_id % 2 = 0 THEN value END, 2.0) AS tr, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'j-' END AS pe_direction FROM events")
def _(spark, d):
    body = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.col("value").alias("RepetitionTime"), F.col("event_type").alias("PhaseEncodingDirection")))).otherwise(F.col("props"))
    return readers.parse_sidecars(table(spark, d, "events").select(F.col("event_id").alias("path"), body.alias("body"))).select("path", "tr", "pe_direction")


@query("S4_read_components", "SELECT doc_id::INTEGER AS component_id, n_chars::DOUBLE AS kappa, (n_chars % 13)::DOUBLE AS rho, source AS classification FROM documents")
def _(spark, d):
    raw = table(spark, d, "documents").select(F.concat(F.lit("ICA_"), "doc_id").alias("Component"), F.col("n_chars").cast("string").alias("kappa"), (F.col("n_chars") % 13).cast("string").alias("rho"), F.col("source").alias("classification"))
    return readers.name_components(raw).select("component_id", "kappa", "rho", "classification")


@query("S5_read_matrix_text", "SELECT l_orderkey * 10 + l_linenumber AS frame, l_quantity AS p1, l_discount AS p2, l_tax AS p3 FROM lineitem")
def _(spark, d):
    line = F.concat_ws("  ", F.col("l_quantity").cast("string"), F.col("l_discount").cast("string"), F.col("l_tax").cast("string"))
    return readers.parse_matrix(table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("frame"), line.alias("line")), 3)


@query("S6_read_keep", "SELECT o_custkey AS run, pos - 1 AS frame, v = 1 AS keep FROM (SELECT o_custkey, unnest(l) AS v, generate_subscripts(l, 1)::INTEGER AS pos FROM (SELECT o_custkey, list(o_orderkey % 3 ORDER BY o_orderkey) AS l FROM orders GROUP BY 1))")
def _(spark, d):
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey"))), lambda x: (x["o_orderkey"] % 3).cast("string")))
    return readers.parse_keep(table(spark, d, "orders").groupBy(F.col("o_custkey").alias("run")).agg(text.alias("text")))


@query("S7_read_edges", sql("nodes", "SELECT src, dst, round(dist + 1e-9, 6) + 0.0 AS dist FROM near JOIN nodes a ON a.node_id = src JOIN nodes b ON b.node_id = dst WHERE a.label_id < 5 AND b.label_id < 5", _NEAR.format(0.08)))
def _(spark, d):
    n = nodes(spark, d)
    return rounded(readers.read_edges(near_pairs(n, 0.08), n.filter("label_id < 5")), "dist").select("src", "dst", "dist")


@query("S8_read_label_lut", "SELECT n_nationkey::INTEGER AS label_id, n_name AS name, (n_nationkey * 7)::INTEGER AS r, n_regionkey::INTEGER AS g, 3 AS b, 255 AS a FROM nation")
def _(spark, d):
    record = F.concat("n_name", F.lit("\n"), F.concat_ws(" ", "n_nationkey", (F.col("n_nationkey") * 7).cast("string"), "n_regionkey", F.lit("3 255")))
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", record.alias("r")))), lambda x: x["r"]))
    return readers.parse_label_lut(table(spark, d, "nation").agg(text.alias("text")))


@query("S9_parse_filecount", "SELECT o_orderkey::INTEGER AS series, o_custkey::INTEGER AS n_images FROM orders WHERE o_orderkey % 3 > 0")
def _(spark, d):
    line = F.when(F.col("o_orderkey") % 3 > 0, F.concat_ws(", ", F.col("o_custkey").cast("string"), "o_orderpriority", F.concat(F.lit("S"), "o_orderkey", F.lit(",")))).otherwise("no series here")
    return readers.parse_filecount(table(spark, d, "orders").select(line.alias("line")))


@query("S10_write_signal", sql("signal", "SELECT node_id, frame, value::FLOAT AS value FROM signal"))
def _(spark, d):
    return signal(spark, d).withColumn("value", F.col("value").cast("float"))


@query("S12_write_manifest", f"SELECT page_id AS series, role, CASE WHEN role IN ('ignore', 'unknown') THEN NULL ELSE 'out/' || role || '/series_' || page_id END AS destination, reason FROM (SELECT page_id, {SERIES_SQL} AS role, {REASON_SQL} AS reason FROM pages)")
def _(spark, d):
    return sinks.manifest(classify_series(table(spark, d, "pages").select(F.col("page_id").alias("series"), F.col("url").alias("description")), URL_RULES), "out")
