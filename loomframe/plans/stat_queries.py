"""Queries of the aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import stats as op
from loomframe.plans.adapters import echoes, nodes, rounded, run_signal, signal, sql, table, vectors
from loomframe.plans.registry import query

#: As adapters.r6: a value half-way between two roundings goes up in both engines.
R = "round({0} + 1e-9, 6) + 0.0 AS {1}".format


@query("A1_temporal_reduce", sql("signal", f"SELECT node_id, {R('avg(value)', 'mean')}, {R('stddev_samp(value)', 'sd')}, min(value) AS low, max(value) AS high FROM signal GROUP BY 1"))
def _(spark, d):
    return rounded(op.temporal_reduce(signal(spark, d)), "mean", "sd")


@query("A2_global_signal", sql("signal", f"SELECT frame, {R('avg(value)', 'gs')} FROM signal WHERE node_id % 3 = 0 GROUP BY 1"))
def _(spark, d):
    s = signal(spark, d)
    return rounded(op.global_signal(s, s.filter("node_id % 3 = 0").select("node_id")), "gs")


@query("A3_temporal_sd_percent", sql("signal", f"SELECT node_id, {R('CASE WHEN abs(avg(value)) > 1e-8 THEN coalesce(100 * stddev_samp(value) / abs(avg(value)), 0.0) ELSE 0.0 END', 'sd_percent')} FROM signal GROUP BY 1"))
def _(spark, d):
    return rounded(op.temporal_sd_percent(signal(spark, d)), "sd_percent")


@query("A4_snr_maps", sql("run_signal", f"SELECT node_id, {R('coalesce(sqrt(n) / nullif(m, 0), 0.0)', 'cov')}, {R('coalesce(m / nullif(sqrt(n), 0), 0.0)', 'tsnr')}, {R('coalesce(sqrt(g) / nullif(sqrt(n), 0), 0.0)', 'cnr')} FROM (SELECT node_id, avg(value) AS m, var_pop(value) AS n, var_pop(value) FILTER (run = 0) AS g FROM run_signal GROUP BY 1)"))
def _(spark, d):
    m = run_signal(spark, d).groupBy("node_id").agg(F.avg("value").alias("mean"), F.var_pop("value").alias("noise_var"), F.var_pop(F.when(F.col("run") == 0, F.col("value"))).alias("signal_var"))
    return rounded(op.snr_maps(m), "cov", "tsnr", "cnr")


@query("A5_modal_value", "SELECT l_suppkey, l_linenumber FROM (SELECT l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, min(l_orderkey), l_linenumber) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1")
def _(spark, d):
    return op.modal_value(table(spark, d, "lineitem"), "l_linenumber", "l_orderkey", ["l_suppkey"])


@query("A6_mean_readout", f"SELECT {R('coalesce(a, p)', 'ap')}, {R('coalesce(p, a)', 'pa')} FROM (SELECT avg(t) FILTER (l_returnflag = 'A') AS a, avg(t) FILTER (l_returnflag = 'N') AS p FROM (SELECT l_returnflag, coalesce(CASE WHEN l_linenumber > 2 THEN l_tax END, l_discount * (l_quantity - 1)) AS t FROM lineitem))")
def _(spark, d):
    t = table(spark, d, "lineitem")
    side = t.select(F.when(F.col("l_returnflag") == "A", "ap").when(F.col("l_returnflag") == "N", "pa").alias("direction"), F.when(F.col("l_linenumber") > 2, F.col("l_tax")).alias("total"), F.col("l_discount").alias("spacing"), F.col("l_quantity").alias("lines"))
    return rounded(op.mean_readout(side), "ap", "pa")


@query("A7_total_minutes", sql("run_signal", f"SELECT {R('sum(n * coalesce(CASE WHEN node_id % 2 = 0 THEN 1.5::DOUBLE END, 2.0)) / 60', 'minutes')} FROM (SELECT node_id, run, count(*) AS n FROM run_signal GROUP BY 1, 2)"))
def _(spark, d):
    runs = run_signal(spark, d).groupBy("node_id", "run").agg(F.count(F.lit(1)).alias("n_frames")).withColumn("tr", F.when(F.col("node_id") % 2 == 0, 1.5))
    return rounded(op.total_minutes(runs), "minutes")


@query("A8_coverage", f"SELECT count(*) FILTER (l_discount <> 0) AS nonzero, count(*) AS total, {R('100.0 * count(*) FILTER (l_discount <> 0) / count(*)', 'percent')}, count(*) FILTER (l_discount <> 0) = count(*) AS complete FROM lineitem")
def _(spark, d):
    return rounded(op.coverage(table(spark, d, "lineitem"), "l_discount"), "percent")


_STRUCTURE = "CASE WHEN label_id < 4 THEN 'cortex' ELSE 's' || label_id END"
_MAPS = "maps AS (SELECT node_id, c - 1 AS component_id, ts[c] AS loading, CASE WHEN label_id < 4 THEN 'cortex' ELSE 's' || label_id END AS structure FROM vectors, range(1, 65) r(c))"


def component_maps(spark, d):
    return vectors(spark, d).select("node_id", F.posexplode("ts").alias("component_id", "loading"))


@query("A10_subcortical_ratio", sql("vectors", f"SELECT component_id::INTEGER AS component_id, {R('s / (c + 1e-8)', 'ratio')} FROM (SELECT component_id, max(m) FILTER (structure = 'cortex') AS c, max(m) FILTER (structure <> 'cortex') AS s FROM (SELECT component_id, structure, avg(abs(loading)) AS m FROM maps GROUP BY 1, 2) GROUP BY 1)", _MAPS))
def _(spark, d):
    structure = F.when(F.col("label_id") < 4, "cortex").otherwise(F.concat(F.lit("s"), F.col("label_id")))
    return rounded(op.subcortical_ratio(component_maps(spark, d), vectors(spark, d).select("node_id", structure.alias("structure"))), "ratio")


@query("A11_parcellate", sql("signal", f"SELECT (node_id % 7)::INTEGER AS parcel, frame, {R('avg(value)', 'value')} FROM signal WHERE node_id % 7 > 0 GROUP BY 1, 2"))
def _(spark, d):
    s = signal(spark, d)
    return rounded(op.parcellate(s, s.select("node_id", (F.col("node_id") % 7).cast("int").alias("label_id")).distinct()), "value")


@query("A12_group_average", sql("run_signal", f"SELECT frame AS node_id, {R('avg(value)', 'mean')}, {R('stddev_samp(value)', 'sd')}, count(*) AS n FROM (SELECT *, avg(value) OVER (PARTITION BY frame) AS m, stddev_samp(value) OVER (PARTITION BY frame) AS s FROM run_signal) WHERE coalesce(abs(value - m) <= 1.5 * s, true) GROUP BY 1"))
def _(spark, d):
    maps = run_signal(spark, d).select(F.col("frame").alias("node_id"), "value")
    return rounded(op.group_average(maps, 1.5), "mean", "sd")


@query("A12_group_mean_absolute", sql("run_signal", f"SELECT frame AS node_id, {R('avg(abs(value - 50))', 'mean')}, {R('stddev_samp(abs(value - 50))', 'sd')}, count(*) AS n FROM run_signal GROUP BY 1"))
def _(spark, d):
    maps = run_signal(spark, d).select(F.col("frame").alias("node_id"), (F.col("value") - 50).alias("value"))
    return rounded(op.group_average(maps, None, absolute=True), "mean", "sd")


@query("A13_group_mode", "SELECT l_partkey AS node_id, l_linenumber AS label FROM (SELECT l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, min(l_orderkey), l_linenumber) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1")
def _(spark, d):
    t = table(spark, d, "lineitem").select(F.col("l_partkey").alias("node_id"), F.col("l_linenumber").alias("label"), "l_orderkey")
    return op.modal_value(t, "label", "l_orderkey", ["node_id"])


@query("A14_grand_mean_scale", sql("signal", f"SELECT node_id, frame, {R('greatest(0.0, value * 10000 / (SELECT avg(value) FROM signal WHERE node_id % 4 = 1))', 'value')} FROM signal"))
def _(spark, d):
    s = signal(spark, d)
    return rounded(op.grand_mean_scale(s, s.filter("node_id % 4 = 1")), "value")


@query("A15_baseline_rescale", sql("signal", f"SELECT node_id AS series, frame, {R('value * (SELECT b FROM base ORDER BY node_id LIMIT 1) / b', 'value')} FROM signal JOIN base USING (node_id)", "base AS (SELECT node_id, avg(value) FILTER (frame % 10 * 100 < 250) AS b FROM signal GROUP BY 1)"))
def _(spark, d):
    f = signal(spark, d).select(F.col("node_id").alias("series"), "frame", (F.col("frame") % 10 * 100).alias("bval"), "value")
    return rounded(op.baseline_rescale(f, 250), "value").select("series", "frame", "value")


@query("A16_robust_band", "SELECT o_orderkey, o_totalprice FROM orders, (SELECT quantile_cont(o_totalprice, 0.5) AS m, stddev_samp(o_totalprice) AS s FROM orders) WHERE abs(o_totalprice - m) <= s / 3")
def _(spark, d):
    return op.robust_band(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")


def _mad(k: int) -> str:
    src = "signal" if k == 0 else f"(SELECT * FROM signal WHERE frame IN (SELECT frame FROM g{k - 1}))"
    return f"m{k} AS (SELECT node_id, avg(value) AS m FROM {src} GROUP BY 1), s{k} AS (SELECT frame, avg((value - m) ** 2) AS s FROM signal JOIN m{k} USING (node_id) GROUP BY 1), d{k} AS (SELECT *, (SELECT quantile_cont(s, 0.5) FROM s{k}) AS med FROM s{k}), g{k} AS (SELECT frame FROM d{k} WHERE s < med + 2 * (SELECT quantile_cont(abs(s - med), 0.5) FROM d{k}))"


@query("A17_mad_average", sql("signal", f"SELECT node_id, {R('avg(value)', 'value')} FROM signal WHERE frame IN (SELECT frame FROM g2) GROUP BY 1", ", ".join(_mad(k) for k in range(3))))
def _(spark, d):
    return rounded(op.mad_average(signal(spark, d)), "value")


@query("A18_echo_average", sql("echoes", f"SELECT node_id, {R('avg(value)', 'value')} FROM echoes GROUP BY 1"))
def _(spark, d):
    return rounded(op.echo_average(echoes(spark, d)), "value")


@query("A19_run_mean_maps", sql("run_signal", f"SELECT node_id, {R('avg(m)', 'mean')}, {R('avg(v)', 'vn')} FROM (SELECT run, node_id, avg(value) AS m, stddev_pop(value) AS v FROM run_signal GROUP BY 1, 2) GROUP BY 1"))
def _(spark, d):
    return rounded(op.run_mean_maps(run_signal(spark, d)), "mean", "vn")


_FILES = "files AS (SELECT l_suppkey AS series, l_linenumber::INTEGER AS echo, sum(l_extendedprice) AS bytes, count(*) AS volumes, min(l_returnflag) AS description FROM lineitem GROUP BY 1, 2)"


def files(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("series"), F.col("l_linenumber").cast("int").alias("echo")).agg(F.sum("l_extendedprice").alias("bytes"), F.count(F.lit(1)).alias("volumes"), F.min("l_returnflag").alias("description"))


@query("A20_qa_sizes", f"WITH {_FILES} SELECT series, echo, {R('bytes / 1e6', 'megabytes')}, volumes FROM files")
def _(spark, d):
    return rounded(op.qa_sizes(files(spark, d)), "megabytes")


@query("A21_validate_echo_groups", f"WITH {_FILES}, g AS (SELECT series, list(echo ORDER BY echo) AS e, count(DISTINCT description) AS names, min(bytes) AS least, min(volumes) AS lo, count(*) AS n FROM files GROUP BY 1), p AS (SELECT *, CASE WHEN e <> [1, 2, 3, 4, 5, 6, 7] THEN 'echo gap' WHEN names > 1 THEN 'descriptions differ' WHEN least < 1600000 THEN 'too small' END AS problem FROM g) SELECT series, n, problem IS NULL AS ok, coalesce(problem, '') AS problem, lo AS volumes FROM p")
def _(spark, d):
    return op.validate_echo_groups(files(spark, d), 7, 1_600_000.0)


@query("A22_gram", sql("signal", f"SELECT a.frame AS i, b.frame AS j, {R('sum(a.value * b.value)', 'g')} FROM signal a JOIN signal b ON a.node_id = b.node_id AND a.frame <= b.frame GROUP BY 1, 2"))
def _(spark, d):
    return rounded(op.gram(signal(spark, d)), "g")


@query("A23_residual_variance_ratio", f"SELECT l_suppkey AS node_id, {R('coalesce(var_samp(l_discount) / nullif(var_samp(l_quantity), 0), 0.0)', 'l_discount')}, {R('coalesce(var_samp(l_tax) / nullif(var_samp(l_quantity), 0), 0.0)', 'l_tax')} FROM lineitem GROUP BY 1")
def _(spark, d):
    t = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "node_id")
    return rounded(op.residual_variance_ratio(t, ["l_discount", "l_tax"], "l_quantity"), "l_discount", "l_tax")


@query("A24_normalise_by_mean", sql("nodes", f"SELECT node_id, {R('x / (SELECT avg(x) FROM nodes WHERE label_id < 5)', 'x')} FROM nodes"))
def _(spark, d):
    n = nodes(spark, d).select("node_id", "label_id", "x")
    return rounded(op.normalise_by_mean(n, n.filter("label_id < 5"), "x").select("node_id", "x"), "x")


@query("A25_stack_modalities", sql("vectors", f"SELECT modality, map::INTEGER AS map, node_id, {R('value / s * (1 + modality / 2.0) * (SELECT s FROM q WHERE modality = 0)', 'value')} FROM m JOIN q USING (modality)", "m AS (SELECT (c - 1) % 3 AS modality, c - 1 AS map, node_id, ts[c] AS value FROM vectors, range(1, 65) r(c)), q AS (SELECT modality, avg(s) AS s FROM (SELECT modality, map, stddev_samp(value) AS s FROM m GROUP BY 1, 2) GROUP BY 1)"))
def _(spark, d):
    m = vectors(spark, d).select("node_id", F.posexplode("ts").alias("map", "value")).withColumn("modality", (F.col("map") % 3).cast("long"))
    w = spark.createDataFrame([(i, 1 + i / 2.0) for i in range(3)], "modality long, weight double")
    return rounded(op.stack_modalities(m, w).select("modality", "map", "node_id", "value"), "value")
