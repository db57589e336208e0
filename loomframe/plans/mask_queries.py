"""Queries of masks, predicates, set operations and scalar functions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from loomframe.functions import scalars as fn
from loomframe.operators import masks as op
from loomframe.plans.adapters import components, echoes, nodes, r6, rounded, run_signal, signal, sql, table, vectors
from loomframe.plans.registry import query
from loomframe.plans.stat_queries import R, component_maps

#: Rules for the urls of pages, which stand for descriptions of series in the queries.
URL_RULES = [
    ("ignore", r"utm_source", "ignored by pattern"),
    ("t1w", r"/en/", "T1-weighted"),
    ("t2w", r"/fr/", "T2-weighted"),
    ("ap", r"/de/", "field map AP"),
    ("pa", r"/es/1", "field map PA"),
    ("sbref", r"\.html", "single-band reference"),
    ("rest", r"/es/", "resting run"),
]
SERIES_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(url), '{p}') THEN '{r}'" for r, p, _ in URL_RULES) + " ELSE 'unknown' END"
REASON_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(url), '{p}') THEN '{w}'" for _, p, w in URL_RULES) + " ELSE 'no rule matched' END"


@query("P1_map_math", sql("signal", f"SELECT node_id, {R('greatest(0.0, least(100.0, a / b))', 'value')} FROM (SELECT node_id, avg(value) AS a, avg(value) FILTER (frame % 2 = 0) AS b FROM signal GROUP BY 1)"))
def _(spark, d):
    s = signal(spark, d)
    a = s.groupBy("node_id").agg(F.avg("value").alias("value"))
    b = s.groupBy("node_id").agg(F.avg(F.when(F.col("frame") % 2 == 0, F.col("value"))).alias("value"))
    return rounded(op.map_math([("a", a), ("b", b)], "greatest(0, least(100, a / b))"), "value")


@query("P2_threshold", sql("signal", "SELECT node_id, frame, CASE WHEN value BETWEEN 200 AND 700 THEN value ELSE 0 END AS value FROM signal"))
def _(spark, d):
    return op.threshold(signal(spark, d), 200, 700)


@query("P2_threshold_invert", sql("signal", "SELECT node_id, frame, CASE WHEN value BETWEEN 200 AND 700 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS value FROM signal"))
def _(spark, d):
    return op.threshold(signal(spark, d), 200, 700, invert=True)


@query("P3_apply_mask", sql("signal", "SELECT node_id, frame, CASE WHEN node_id % 3 = 0 THEN value ELSE 0 END AS value FROM signal"))
def _(spark, d):
    s = signal(spark, d)
    return op.apply_mask(s, s.filter("node_id % 3 = 0"), drop=False)


@query("P4_label_mask", sql("nodes", "SELECT node_id FROM nodes WHERE label_id IN (1, 4, 7)"))
def _(spark, d):
    return op.label_mask(nodes(spark, d), [1, 4, 7])


@query("P5_label_import", sql("nodes", "SELECT node_id, label_id, n_name AS name FROM nodes JOIN nation ON n_nationkey = label_id WHERE n_nationkey < 8"))
def _(spark, d):
    lut = table(spark, d, "nation").filter("n_nationkey < 8").select(F.col("n_nationkey").alias("label_id"), F.col("n_name").alias("name"))
    return op.label_import(nodes(spark, d).select("node_id", "label_id"), lut).select("node_id", "label_id", "name")


@query("P6_select_structures", "SELECT s_suppkey AS node_id, upper(n_name) AS structure FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_nationkey < 12 AND s_suppkey NOT IN (3, 11)")
def _(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", F.concat(F.lit("CIFTI_STRUCTURE_"), F.lower("n_name")).alias("structure"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("node_id"), "structure")
    names = [r["n_name"] for r in table(spark, d, "nation").filter("n_nationkey < 12").select("n_name").collect()]
    return op.select_structures(s, names, [4, 12])


@query("P10_nonzero_nodes", sql("run_signal", "SELECT node_id FROM run_signal GROUP BY 1 HAVING max(value) - min(value) > 0"))
def _(spark, d):
    return op.nonzero_nodes(run_signal(spark, d))


@query("P11_classify_series", f"SELECT page_id, {SERIES_SQL} AS role, {REASON_SQL} AS reason FROM pages")
def _(spark, d):
    return op.classify_series(table(spark, d, "pages").select("page_id", F.col("url").alias("description")), URL_RULES).select("page_id", "role", "reason")


@query("P12_initial_keep", sql("components", "SELECT component_id, lower(trim(classification)) IN ('accepted', 'provisionalaccept') AS keep FROM components"))
def _(spark, d):
    return op.initial_keep(components(spark, d)).select("component_id", "keep")


@query("P13_select_dwi_vols", "SELECT o_orderkey, bval FROM (SELECT o_orderkey, (o_orderkey * 7 % 3000)::INTEGER AS bval FROM orders) WHERE abs(bval - 1000) < 100 OR abs(bval - 2000) < 100")
def _(spark, d):
    return op.select_dwi_vols(table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 7 % 3000).cast("int").alias("bval")), [1000, 2000])


_MAPS = "maps AS (SELECT node_id, (c - 1)::INTEGER AS component_id, ts[c] AS loading FROM vectors, range(1, 65) r(c))"


@query("P14_subset_components", sql("vectors", "SELECT CASE component_id WHEN 9 THEN 0 WHEN 2 THEN 1 ELSE 2 END::INTEGER AS position, node_id, loading FROM maps WHERE component_id IN (9, 2, 40)", _MAPS))
def _(spark, d):
    return op.subset_components(component_maps(spark, d), [9, 2, 40, 999])


@query("P15_check_series", f"WITH s AS (SELECT page_id % 200 AS series, {SERIES_SQL} AS role, length(html) AS bytes, length(url) AS volumes FROM pages) SELECT series, 'too small' AS problem FROM s WHERE bytes < 2000 UNION ALL SELECT series, 'unknown role' FROM s WHERE role = 'unknown' UNION ALL SELECT series, 'number used twice' FROM s GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT min(series), 'too many t1w' FROM s WHERE role = 't1w' HAVING count(*) > 2")
def _(spark, d):
    s = op.classify_series(table(spark, d, "pages").select("page_id", F.col("url").alias("description"), "html"), URL_RULES)
    return op.check_series(s.select((F.col("page_id") % 200).alias("series"), "role", F.length("html").alias("bytes"), F.length("description").alias("volumes")), 2000, None, {"t1w": 2})


@query("P16_check_sidecars", "WITH e AS (SELECT event_id AS path, CASE WHEN event_id % 3 = 0 THEN '{\"EchoTime\": 1, \"SliceTiming\": 2, \"Dir\": \"q\"}' WHEN event_id % 3 = 1 THEN '{\"SliceTiming\": [1, 2], \"Dir\": \"j-\"}' ELSE props END AS body FROM events) SELECT path, unnest(list_filter([CASE WHEN json_extract_string(body, '$.EchoTime') IS NULL THEN 'missing EchoTime' END, CASE WHEN json_type(body, '$.SliceTiming') <> 'ARRAY' THEN 'SliceTiming is not an array' END, CASE WHEN json_extract_string(body, '$.Dir') NOT IN ('i', 'i-', 'j', 'j-', 'k', 'k-') THEN 'bad direction' END], lambda x: x IS NOT NULL)) AS problem FROM e")
def _(spark, d):
    e = table(spark, d, "events")
    body = F.when(F.col("event_id") % 3 == 0, F.lit('{"EchoTime": 1, "SliceTiming": 2, "Dir": "q"}')).when(F.col("event_id") % 3 == 1, F.lit('{"SliceTiming": [1, 2], "Dir": "j-"}')).otherwise(F.col("props"))
    return op.check_sidecars(e.select(F.col("event_id").alias("path"), body.alias("body")), ["EchoTime"], ["SliceTiming"], "Dir")


@query("P17_good_nodes", sql("nodes", "SELECT node_id, coalesce(r <= (SELECT avg(r) + 0.5 * stddev_samp(r) FROM q), false) AS good FROM q", "m AS (SELECT label_id, avg(abs(x)) AS s FROM nodes GROUP BY 1), q AS (SELECT node_id, abs(x) / s AS r FROM nodes JOIN m USING (label_id))"))
def _(spark, d):
    n = nodes(spark, d)
    means = n.groupBy("label_id").agg(F.avg(F.abs("x")).alias("value"))
    return op.good_nodes(n.select("node_id", F.abs("x").alias("value")), n.select("node_id", "label_id").join(means, "label_id"))


@query("P18_short_echo", sql("echoes", f"SELECT node_id, {R('avg(value)', 'value')} FROM echoes WHERE te < 60 GROUP BY 1"))
def _(spark, d):
    return rounded(op.short_echo(echoes(spark, d)).groupBy("node_id").agg(F.avg("value").alias("value")), "value")


@query("P19_fov_mask", "SELECT l_suppkey AS node_id FROM (SELECT l_suppkey, l_linenumber, sum(CASE WHEN l_discount > 0.02 THEN l_quantity ELSE 0 END) - 90 AS value FROM lineitem GROUP BY 1, 2) GROUP BY 1 HAVING min(abs(value)) > 0")
def _(spark, d):
    v = F.sum(F.when(F.col("l_discount") > 0.02, F.col("l_quantity")).otherwise(0)) - 90
    return op.fov_mask(table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("node_id"), "l_linenumber").agg(v.alias("value")))


@query("P20_bias_revert", sql("signal", f"SELECT node_id, frame, {R('value * (1 + s_suppkey % 5) / (2 + s_nationkey)', 'value')} FROM signal JOIN supplier ON s_suppkey = node_id"))
def _(spark, d):
    s = table(spark, d, "supplier")
    old, new = s.select(F.col("s_suppkey").alias("node_id"), (1 + F.col("s_suppkey") % 5).alias("value")), s.select(F.col("s_suppkey").alias("node_id"), (2 + F.col("s_nationkey")).alias("value"))
    return rounded(op.bias_revert(signal(spark, d), old, new), "value")


@query("U3_mask_union", sql("nodes", "SELECT node_id FROM nodes WHERE label_id < 3 OR x > 0.1"))
def _(spark, d):
    n = nodes(spark, d)
    return op.mask_union(n.filter("label_id < 3"), n.filter("x > 0.1"))


@query("U3_mask_intersect", sql("nodes", "SELECT node_id FROM nodes WHERE label_id < 3 AND x > 0.1"))
def _(spark, d):
    n = nodes(spark, d)
    return op.mask_intersect(n.filter("label_id < 3"), n.filter("x > 0.1"))


@query("U3_mask_except", sql("nodes", "SELECT node_id FROM nodes WHERE label_id < 3 AND NOT x > 0.1"))
def _(spark, d):
    n = nodes(spark, d)
    return op.mask_except(n.filter("label_id < 3"), n.filter("x > 0.1"))


@query("U4_merge_labels", sql("nodes", "SELECT node_id, CASE WHEN a IN (7, 8) THEN a WHEN o IN (1, 2, 3) AND o IS DISTINCT FROM a THEN 0 WHEN o = 5 THEN 0 ELSE coalesce(o, 0) END::INTEGER AS label_id FROM (SELECT node_id, label_id AS o, CASE WHEN y > 0 THEN label_id WHEN node_id % 2 = 0 THEN 7 END AS a FROM nodes)"))
def _(spark, d):
    n = nodes(spark, d).select("node_id", "label_id", "y")
    aux = n.select("node_id", F.when(F.col("y") > 0, F.col("label_id")).when(F.col("node_id") % 2 == 0, 7).alias("label_id"))
    return op.merge_labels(n, aux, [1, 2, 3], [7, 8], 5)


@query("U5_partition_components", sql("components", "SELECT component_id, CASE WHEN manual_reject THEN 'noise' ELSE 'signal' END AS kind FROM components"))
def _(spark, d):
    c = components(spark, d)
    return op.partition_components(c.select("component_id"), c.filter("manual_reject"))


@query("U6_check_continuity", "WITH a AS (SELECT l_suppkey AS series, list(DISTINCT l_linenumber::INTEGER) AS a FROM lineitem WHERE (l_suppkey + l_linenumber) % 5 <> 0 GROUP BY 1), b AS (SELECT l_suppkey AS series, list(DISTINCT l_linenumber::INTEGER) AS b FROM lineitem WHERE l_linenumber <> 3 OR l_suppkey % 2 = 0 GROUP BY 1), j AS (SELECT series, coalesce(a, []) AS a, coalesce(b, []) AS b FROM a FULL JOIN b USING (series)), m AS (SELECT series, list_filter(range(1, greatest(list_max(a), list_max(b)) + 1), lambda x: NOT list_contains(a, x)) AS missing_images, list_filter(range(1, greatest(list_max(a), list_max(b)) + 1), lambda x: NOT list_contains(b, x)) AS missing_sidecars FROM j) SELECT series, missing_images::INTEGER[] AS missing_images, missing_sidecars::INTEGER[] AS missing_sidecars FROM m WHERE len(missing_images) + len(missing_sidecars) > 0")
def _(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("series"), F.col("l_linenumber").cast("int").alias("echo"))
    return op.check_continuity(e.filter("(series + echo) % 5 <> 0"), e.filter("echo <> 3 OR series % 2 = 0"))


@query("U7_merge_maps", sql("nodes", "SELECT 'a' AS subject, node_id, x AS value FROM nodes UNION ALL SELECT 'b', node_id, y FROM nodes"))
def _(spark, d):
    n = nodes(spark, d)
    return op.merge_maps([("a", n.select("node_id", F.col("x").alias("value"))), ("b", n.select("node_id", F.col("y").alias("value")))])


@query("F1_component_id", "SELECT doc_id, regexp_extract(source, '([0-9]+)$', 1)::INTEGER AS component_id FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", fn.component_id(F.col("source")).alias("component_id"))


@query("F2_manual_id", "SELECT doc_id, regexp_extract(name, '(?i)(?:comp|ica)[_-]?([0-9]+)', 1)::INTEGER AS id FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Comp_' WHEN 1 THEN 'ICA-' ELSE 'comp' END || doc_id || '.txt' AS name FROM documents)")
def _(spark, d):
    name = F.concat(F.when(F.col("doc_id") % 3 == 0, "Comp_").when(F.col("doc_id") % 3 == 1, "ICA-").otherwise("comp"), F.col("doc_id"), F.lit(".txt"))
    return table(spark, d, "documents").withColumn("name", name).select("doc_id", fn.manual_id(F.col("name")).alias("id"))


_BIDS = "('sub-' || o_custkey || '_ses-' || o_orderpriority[1] || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '_run-' || (o_orderkey % 4) END || '_echo-' || (o_orderkey % 5) || '_bold.nii.gz')"


def bids(spark, d):
    name = F.concat(F.lit("sub-"), "o_custkey", F.lit("_ses-"), F.substring("o_orderpriority", 1, 1), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("_run-"), F.col("o_orderkey") % 4)), F.lit("_echo-"), F.col("o_orderkey") % 5, F.lit("_bold.nii.gz"))
    return table(spark, d, "orders").select("o_orderkey", name.alias("name"))


@query("F3_parse_entities", f"SELECT o_orderkey, o_custkey::VARCHAR AS sub, CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 4)::VARCHAR END AS run, (o_orderkey % 5)::VARCHAR AS echo, regexp_extract({_BIDS}, '_([^_]*)\\.nii\\.gz$', 1) AS suffix FROM orders")
def _(spark, d):
    entities, suffix = fn.parse_entities(F.col("name"))
    return bids(spark, d).select("o_orderkey", entities.alias("e"), suffix.alias("suffix")).select("o_orderkey", *[F.col("e")[k].alias(k) for k in ("sub", "run", "echo")], "suffix")


@query("F4_run_group_key", f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN regexp_extract({_BIDS}, '^(.*)_echo-', 1) ELSE 'run-' || (o_orderkey % 4) END AS key FROM orders")
def _(spark, d):
    return bids(spark, d).select("o_orderkey", fn.run_group_key(F.col("name")).alias("key"))


@query("F5_series_number", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE doc_id END::INTEGER AS number FROM documents")
def _(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars").cast("string")).otherwise("none").alias("v"), F.concat(F.lit("scan_series-"), "doc_id").alias("name"))
    return t.select("doc_id", fn.series_number("v", "name").alias("number"))


@query("F6_numeric_echo", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN n_chars END::INTEGER AS echo FROM documents")
def _(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars").cast("string")).otherwise("1a").alias("v"))
    return t.select("doc_id", fn.numeric_echo("v").alias("echo"))


_DIR = "['i', 'i-', 'j', 'j-', 'k', 'k-', 'x'][1 + doc_id % 7]"


@query("F7_pe_to_vector", f"SELECT doc_id, CASE {_DIR} WHEN 'i' THEN '1,0,0' WHEN 'i-' THEN '-1,0,0' WHEN 'j' THEN '0,1,0' WHEN 'j-' THEN '0,-1,0' WHEN 'k' THEN '0,0,1' WHEN 'k-' THEN '0,0,-1' END AS v, CASE WHEN {_DIR} = 'j-' THEN '-y' ELSE 'y' END AS axis FROM documents")
def _(spark, d):
    dirs = F.array(*[F.lit(x) for x in (*op.PHASE_DIRECTIONS, "x")])
    t = table(spark, d, "documents").select("doc_id", F.element_at(dirs, (1 + F.col("doc_id") % 7).cast("int")).alias("d"))
    return t.select("doc_id", F.array_join(fn.pe_to_vector(F.col("d")).cast("array<string>"), ",").alias("v"), fn.pe_to_axis(F.col("d")).alias("axis"))


@query("F8_pe_to_axis", f"SELECT doc_id, CASE WHEN {_DIR} = 'j-' THEN '-y' ELSE 'y' END AS axis FROM documents")
def _(spark, d):
    dirs = F.array(*[F.lit(x) for x in (*op.PHASE_DIRECTIONS, "x")])
    t = table(spark, d, "documents").select("doc_id", F.element_at(dirs, (1 + F.col("doc_id") % 7).cast("int")).alias("d"))
    return t.select("doc_id", fn.pe_to_axis(F.col("d")).alias("axis"))


@query("F14_clip", f"SELECT o_orderkey, {R('greatest(50000.0::DOUBLE, least(o_totalprice, 200000.0))', 'price')} FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", r6(fn.clip(F.col("o_totalprice"), 50_000.0, 200_000.0)).alias("price"))


@query("F9_te_units", "SELECT l_orderkey, CASE WHEN a < b THEN round(a * f + 1e-9, 6) + 0.0 END AS te1, CASE WHEN a < b THEN round(b * f + 1e-9, 6) + 0.0 END AS te2 FROM (SELECT l_orderkey, min(l_quantity) AS a, max(l_quantity) AS b, CASE WHEN max(l_quantity) > 1 THEN 0.001::DOUBLE ELSE 1 END AS f FROM lineitem GROUP BY 1)")
def _(spark, d):
    t = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array(F.min("l_quantity"), F.max("l_quantity")).alias("te"))
    return rounded(t.select("l_orderkey", fn.te_units(F.col("te")).alias("te")).select("l_orderkey", F.col("te")[0].alias("te1"), F.col("te")[1].alias("te2")), "te1", "te2")


@query("F10_format_g")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fn.format_g(F.col("o_totalprice") / 1e5).alias("text"))


@query("F11_expand_range", "SELECT s_suppkey, round(unnest([0.001, 0.002, 0.003, 0.004, 0.5]) + 1e-9, 6) + 0.0 AS density FROM supplier")
def _(spark, d):
    values = fn.expand_range("0.001:0.001:0.004, 0.5")
    return rounded(table(spark, d, "supplier").select("s_suppkey", F.explode(F.array(*[F.lit(v) for v in values])).alias("density")), "density")


@query("F12_fisher_z", f"SELECT l_orderkey, l_linenumber, l_discount, {R('atanh(l_discount)', 'z')} FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", r6(fn.fisher_z(F.col("l_discount"))).alias("z"))


@query("F13_log_ratio", sql("components", f"SELECT component_id, {R('log10(kappa / greatest(rho, 1e-8) + 1e-8)', 'ratio')}, {R('greatest(-2.0, least(log10(kappa / greatest(rho, 1e-8) + 1e-8), 0.0))', 'clipped')} FROM components"))
def _(spark, d):
    x = fn.log_ratio(F.col("kappa"), F.col("rho"))
    return components(spark, d).select("component_id", r6(x).alias("ratio"), r6(fn.clip(x, -2.0, 0.0)).alias("clipped"))


@query("F15_softmax", sql("nodes", f"SELECT label_id, node_id, {R('exp(x - max(x) OVER w) / (sum(e) OVER w)', 'p')} FROM (SELECT *, exp(x - max(x) OVER (PARTITION BY label_id)) AS e FROM nodes) WINDOW w AS (PARTITION BY label_id)"))
def _(spark, d):
    return rounded(fn.softmax(nodes(spark, d).select("label_id", "node_id", F.col("x").alias("score")), ["label_id"]), "p").drop("score")


@query("F16_sigma_from_fwhm", f"SELECT l_orderkey, l_linenumber, l_quantity, {R(f'l_quantity / {2 * math.sqrt(2 * math.log(2))!r}', 'sigma')} FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", r6(fn.sigma_from_fwhm(F.col("l_quantity"))).alias("sigma"))


@query("F17_t_to_z")
def _(spark, d):
    return nodes(spark, d).select("node_id", r6(fn.t_to_z(F.col("x") * 20, 12.0)).alias("z"))


@query("F18_json_get", "SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, coalesce(json_extract_string(props, '$.missing'), 'default') AS missing FROM events")
def _(spark, d):
    p = F.col("props")
    return table(spark, d, "events").select("event_id", fn.json_get(p, "k", F.lit("none")).alias("k"), fn.json_get(p, "missing", F.lit("default")).alias("missing"))


@query("F19_fill_non_finite", "SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount = 0 THEN -1.0 ELSE round(l_quantity / l_discount + 1e-9, 6) + 0.0 END AS v FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", r6(fn.fill_non_finite(F.try_divide("l_quantity", "l_discount"), -1.0)).alias("v"))


@query("F20_rescale01", sql("nodes", f"SELECT node_id, {R('(x - (SELECT min(x) FROM nodes)) / ((SELECT max(x) FROM nodes) - (SELECT min(x) FROM nodes) + 1e-8)', 'x')} FROM nodes"))
def _(spark, d):
    return rounded(fn.rescale01(nodes(spark, d).select("node_id", "x"), "x"), "x")


@query("F21_euclidean", sql("nodes", f"SELECT node_id, {R('sqrt((x - i) ** 2 + (y - j) ** 2 + (z - k) ** 2)', 'dist')} FROM nodes"))
def _(spark, d):
    return nodes(spark, d).select("node_id", r6(fn.euclidean([F.col(c) for c in "xyz"], [F.col(c) for c in "ijk"])).alias("dist"))


@query("F22_affine_coords", sql("nodes", "SELECT node_id, -2.0::DOUBLE * i + 90 AS mx, 2.0::DOUBLE * j - 126 AS my, 2.0::DOUBLE * k + 0.5 * i - 72 AS mz FROM nodes"))
def _(spark, d):
    mm = fn.affine_coords([F.col(c) for c in "ijk"], [[-2, 0, 0, 90], [0, 2, 0, -126], [0.5, 0, 2, -72]])
    return nodes(spark, d).select("node_id", *[(c + 0.0).alias(n) for c, n in zip(mm, ("mx", "my", "mz"))])


@query("F23_rotate_vectors", sql("nodes", f"SELECT node_id, {R('0.6 * x - 0.8 * y', 'bx')}, {R('0.8 * x + 0.6 * y', 'by')}, {R('z', 'bz')} FROM nodes"))
def _(spark, d):
    out = fn.rotate_vectors([F.col(c) for c in "xyz"], [[0.6, -0.8, 0], [0.8, 0.6, 0], [0, 0, 1]])
    return nodes(spark, d).select("node_id", *[r6(c).alias(n) for c, n in zip(out, ("bx", "by", "bz"))])
