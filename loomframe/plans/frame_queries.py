"""Queries of the frame operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import frames as op
from loomframe.plans.adapters import motion, r6, rounded, run_signal, signal, sql, table
from loomframe.plans.registry import query

P = ["p1", "p2", "p3", "p4", "p5", "p6"]
_LAG = "lag({0}) OVER (PARTITION BY run ORDER BY frame)"
_ABS = " + ".join
_FD = "coalesce(" + _ABS(f"abs({p} - {_LAG.format(p)})" for p in P[3:]) + " + 50 * (" + _ABS(f"abs({p} - {_LAG.format(p)})" for p in P[:3]) + "), 0.0)"


@query("W1_framewise_displacement", sql("motion", f"SELECT run, frame, round({_FD} + 1e-9, 6) + 0.0 AS fd FROM motion"))
def _(spark, d):
    return rounded(op.framewise_displacement(motion(spark, d)), "fd")


@query("W2_fd_from_derivatives", sql("motion", "SELECT run, frame, round(coalesce(" + _ABS(f"abs({p} - {_LAG.format(p)})" for p in P[:3]) + " + 50 * pi() / 180 * (" + _ABS(f"abs({p} - {_LAG.format(p)})" for p in P[3:]) + "), 0.0) + 1e-9, 6) + 0.0 AS fd FROM motion"))
def _(spark, d):
    return rounded(op.fd_from_derivatives(motion(spark, d)), "fd")


@query("W3_backward_difference", sql("signal", "SELECT node_id, frame, round(coalesce(value - lag(value) OVER (PARTITION BY node_id ORDER BY frame), 0.0) + 1e-9, 6) + 0.0 AS d_value FROM signal"))
def _(spark, d):
    return rounded(op.backward_difference(signal(spark, d), ["value"], ["node_id"]), "d_value").select("node_id", "frame", "d_value")


@query("W4_central_difference", sql("signal", "SELECT node_id, frame, round(coalesce(CASE WHEN b IS NULL THEN a - value WHEN a IS NULL THEN value - b ELSE (a - b) / 2 END, 0.0) + 1e-9, 6) + 0.0 AS d_value FROM (SELECT *, lag(value) OVER w AS b, lead(value) OVER w AS a FROM signal WINDOW w AS (PARTITION BY node_id ORDER BY frame))"))
def _(spark, d):
    return rounded(op.central_difference(signal(spark, d), ["value"], ["node_id"]), "d_value").select("node_id", "frame", "d_value")


@query("W5_dvars", sql("signal", "SELECT frame, round(CASE WHEN frame = (SELECT min(frame) FROM per) THEN 0.0 ELSE rms - (SELECT quantile_cont(rms, 0.5) FROM per) END + 1e-9, 6) + 0.0 AS dvars FROM per", "d AS (SELECT frame, value - lag(value) OVER (PARTITION BY node_id ORDER BY frame) AS d FROM signal), per AS (SELECT frame, sqrt(avg(d * d)) AS rms FROM d GROUP BY frame)"))
def _(spark, d):
    return rounded(op.dvars(signal(spark, d)), "dvars")


@query("W6_demean_runs", sql("run_signal", "SELECT run, node_id, frame, round(value - avg(value) OVER (PARTITION BY run, node_id) + 1e-9, 6) + 0.0 AS value FROM run_signal"))
def _(spark, d):
    return rounded(op.demean_runs(run_signal(spark, d)), "value")


@query("W6_var_norm_runs", sql("run_signal", "SELECT run, node_id, frame, round((value - avg(value) OVER w) / CASE WHEN stddev_pop(value) OVER w > 1e-8 THEN stddev_pop(value) OVER w ELSE 1 END + 1e-9, 6) + 0.0 AS value FROM run_signal WINDOW w AS (PARTITION BY run, node_id)"))
def _(spark, d):
    return rounded(op.demean_runs(run_signal(spark, d), True, 1e-8), "value")


@query("W7_standardise", sql("signal", "SELECT node_id, frame, round((value - avg(value) OVER w) / CASE WHEN stddev_pop(value) OVER w > 0 THEN stddev_pop(value) OVER w ELSE 1 END + 1e-9, 6) + 0.0 AS value FROM signal WINDOW w AS (PARTITION BY node_id)"))
def _(spark, d):
    return rounded(op.standardise(signal(spark, d), ["value"], ["node_id"]), "value")


@query("W7_standardise_sample", sql("signal", "SELECT node_id, frame, round((value - avg(value) OVER w) / greatest(stddev_samp(value) OVER w, 1e-5) + 1e-9, 6) + 0.0 AS value FROM signal WINDOW w AS (PARTITION BY node_id)"))
def _(spark, d):
    return rounded(op.standardise(signal(spark, d), ["value"], ["node_id"], True, 1e-5), "value")


_TWELVE = [*P, *[f"d_{p}" for p in P]]
_Z = "({0} - avg({0}) OVER (PARTITION BY run)) / greatest(stddev_samp({0}) OVER (PARTITION BY run), 1e-5)"


@query("W8_expand_motion24", sql("motion", "SELECT run, frame, " + ", ".join([f"round({c} + 1e-9, 6) + 0.0 AS {c}" for c in _TWELVE] + [f"round({_Z.format(c + '_sq')} + 1e-9, 6) + 0.0 AS {c}_sq" for c in _TWELVE]) + " FROM s",
    "b AS (SELECT run, frame, " + ", ".join([*P, *[f"coalesce({p} - {_LAG.format(p)}, 0.0) AS d_{p}" for p in P]]) + " FROM motion), z AS (SELECT run, frame, " + ", ".join(f"{_Z.format(c)} AS {c}" for c in _TWELVE) + " FROM b), s AS (SELECT *, " + ", ".join(f"{c} * {c} AS {c}_sq" for c in _TWELVE) + " FROM z)"))
def _(spark, d):
    out = op.expand_motion24(motion(spark, d))
    return rounded(out, *[c for c in out.columns if c not in ("run", "frame")])


@query("W9_linear_detrend", sql("signal", "SELECT node_id, frame, round(value - avg(value) OVER w - x * sum(x * value) OVER w / (n * (n + 1) / (3.0 * (n - 1))) + 1e-9, 6) + 0.0 AS value FROM (SELECT *, 2.0::DOUBLE * (row_number() OVER (PARTITION BY node_id ORDER BY frame) - 1) / (n - 1) - 1 AS x FROM (SELECT *, count(*) OVER (PARTITION BY node_id) AS n FROM signal)) WINDOW w AS (PARTITION BY node_id)"))
def _(spark, d):
    return rounded(op.linear_detrend(signal(spark, d), ["value"], ["node_id"]), "value")


@query("W12_run_extent", sql("run_signal", "SELECT run, coalesce(sum(n_frames) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, (sum(n_frames) OVER (ORDER BY run))::BIGINT AS stop FROM (SELECT run, count(DISTINCT frame) AS n_frames FROM run_signal GROUP BY run)"))
def _(spark, d):
    return op.run_extent(run_signal(spark, d).groupBy("run").agg(F.countDistinct("frame").alias("n_frames")))


@query("W13_scan_index", sql("run_signal", "SELECT session, run, frame, dense_rank() OVER (ORDER BY session, run)::INTEGER AS scan FROM (SELECT DISTINCT (node_id % 3)::INTEGER AS session, run, frame FROM run_signal)"))
def _(spark, d):
    frames = run_signal(spark, d).select((F.col("node_id") % 3).cast("int").alias("session"), "run", "frame").distinct()
    return op.scan_index(frames).select("session", "run", "frame", "scan")


@query("W14_renumber", "SELECT label, row_number() OVER (ORDER BY n IS NULL, n, label)::INTEGER AS number FROM (SELECT label, CASE WHEN regexp_matches(label, '^[0-9]+$') THEN label::BIGINT END AS n FROM (SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN (n_chars % 50)::VARCHAR ELSE source END AS label FROM documents))")
def _(spark, d):
    label = F.when(F.col("doc_id") % 2 == 0, (F.col("n_chars") % 50).cast("string")).otherwise(F.col("source"))
    return op.renumber(table(spark, d, "documents").select(label.alias("label")))


@query("W15_slice_timing", "WITH t AS (SELECT o_custkey AS series, list(o_totalprice ORDER BY o_orderkey) AS times FROM orders GROUP BY 1), e AS (SELECT series, len(times) // 2 AS n, unnest(times) AS time, generate_subscripts(times, 1) - 1 AS pos FROM t), p AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY time, pos) - 1 AS place FROM e WHERE pos < n) SELECT series, (band * n + pos)::INTEGER AS slice, round((floor(n / 2.0 + 0.5) - 1 - place) / n + 1e-9, 6) + 0.0 AS shift FROM p, (VALUES (0), (1)) b(band)")
def _(spark, d):
    t = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("series")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))), lambda x: x["o_totalprice"]).alias("times"))
    return rounded(op.slice_timing(t, 2), "shift")


@query("W16_echo_size_trend", "WITH f AS (SELECT l_suppkey AS series, l_linenumber::INTEGER AS echo, sum(l_quantity) AS size FROM lineitem GROUP BY 1, 2), n AS (SELECT *, lead(size) OVER (PARTITION BY series ORDER BY echo) AS nxt FROM f) SELECT series, echo, 'not larger than the next' AS warning FROM n WHERE size <= nxt UNION ALL SELECT series, 0 AS echo, 'first not larger than the last' AS warning FROM f GROUP BY series HAVING count(*) > 1 AND arg_min(size, echo) <= arg_max(size, echo)")
def _(spark, d):
    f = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("series"), F.col("l_linenumber").cast("int").alias("echo")).agg(F.sum("l_quantity").alias("size"))
    return op.echo_size_trend(f)


@query("W17_cumulative_cap", "SELECT s_suppkey, coalesce(sum(s_acctbal) OVER (ORDER BY s_acctbal DESC, s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) <= 0.6 * (SELECT sum(s_acctbal) FROM supplier) AS kept FROM supplier")
def _(spark, d):
    return op.cumulative_cap(table(spark, d, "supplier"), "s_acctbal", "s_acctbal", "s_suppkey", 0.6).select("s_suppkey", "kept")


#: One volume of every series a step.
_SPACED = """WITH RECURSIVE f AS (SELECT user_id AS series, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INTEGER AS vol, event_id * 37 % 1000 AS bval FROM events),
s(series, vol, pick) AS (SELECT series, vol, CASE WHEN bval < 300 THEN 0 ELSE -1 END::INTEGER FROM f WHERE vol = 0
UNION ALL SELECT f.series, f.vol, CASE WHEN bval < 300 AND (pick < 0 OR f.vol - pick >= 4) THEN f.vol ELSE pick END FROM s JOIN f ON f.series = s.series AND f.vol = s.vol + 1)
SELECT series, vol, pick FROM s"""


@query("W18_spaced_baselines", _SPACED)
def _(spark, d):
    f = table(spark, d, "events").select(F.col("user_id").alias("series"), "ts", "event_id", (F.col("event_id") * 37 % 1000).cast("int").alias("bval"))
    from pyspark.sql import Window

    vol = (F.row_number().over(Window.partitionBy("series").orderBy("ts", "event_id")) - 1).cast("int")
    return op.spaced_baselines(f.withColumn("vol", vol).select("series", "vol", "bval"), 300, 4)


@query("W19_demean_regressors", sql("motion", "SELECT run, frame, " + ", ".join(f"round({p} - avg({p}) OVER (PARTITION BY run) + 1e-9, 6) + 0.0 AS {p}" for p in P) + " FROM motion"))
def _(spark, d):
    return rounded(op.demean_regressors(motion(spark, d)), *P)


@query("P7_censor", sql("run_signal motion", "SELECT node_id, frame, round(value + 1e-9, 6) + 0.0 AS value FROM run_signal WHERE frame IN (SELECT frame FROM f WHERE fd < 1000)", f"f AS (SELECT frame, {_FD} AS fd FROM motion)"))
def _(spark, d):
    out = op.censor(run_signal(spark, d), op.framewise_displacement(motion(spark, d)), 1000.0)
    return rounded(out, "value").select("node_id", "frame", "value")


@query("P8_excise_frames", sql("signal", "SELECT node_id, frame, value FROM signal WHERE frame % 5 <> 2"))
def _(spark, d):
    s = signal(spark, d)
    keep = s.select("frame").distinct().withColumn("keep", F.col("frame") % 5 != 2)
    return op.excise_frames(s, keep)


@query("P9_drop_initial", sql("signal", "SELECT node_id, (frame - 10)::INTEGER AS frame, value FROM signal WHERE frame >= 10"))
def _(spark, d):
    return op.drop_initial(signal(spark, d))


_CONCAT = "n AS (SELECT run, count(DISTINCT frame) AS n, min(frame) AS f0 FROM run_signal GROUP BY run), x AS (SELECT run, f0, coalesce(sum(n) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, row_number() OVER (ORDER BY run)::INTEGER AS scan FROM n)"


@query("U1_concat_runs", sql("run_signal", "SELECT scan, node_id, (start + frame - f0)::INTEGER AS global_frame, round(value - avg(value) OVER (PARTITION BY run, node_id) + 1e-9, 6) + 0.0 AS value FROM run_signal JOIN x USING (run)", _CONCAT))
def _(spark, d):
    return rounded(op.concat_runs(run_signal(spark, d)), "value")


@query("U2_split_runs", sql("run_signal", "SELECT run, node_id, (frame - f0)::INTEGER AS frame, round(value + 1e-9, 6) + 0.0 AS value FROM run_signal JOIN x USING (run)", _CONCAT))
def _(spark, d):
    s = run_signal(spark, d)
    runs = s.groupBy("run").agg(F.countDistinct("frame").alias("n_frames"))
    means = s.groupBy("run", "node_id").agg(F.avg("value").alias("mean"))
    out = op.split_runs(op.concat_runs(s), op.run_extent(runs), means)
    return out.select("run", "node_id", F.col("frame").cast("int"), r6("value").alias("value"))
