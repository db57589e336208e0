"""Canonical tables (signal, motion, nodes, components, ...) from the driver's tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(x: Column | str) -> Column:
    """Rounded to six digits, without negative zero: what float results are compared by."""
    return F.round((F.col(x) if isinstance(x, str) else x) + 1e-9, 6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, frame, value: ordered quantity per supplier and quarter (28 frames)."""
    t = table(spark, sf_dir, "lineitem")
    frame = (F.year("l_shipdate") - 1995) * 4 + F.quarter("l_shipdate") - 1
    return t.groupBy(F.col("l_suppkey").alias("node_id"), frame.alias("frame")).agg(F.sum("l_quantity").alias("value"))


def run_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run, node_id, frame, value: mean event value per user and day, in ten-day runs."""
    t = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    return t.groupBy(F.floor((day - 1) / 10).cast("int").alias("run"), F.col("user_id").alias("node_id"), day.alias("frame")).agg(F.avg("value").alias("value"))


def motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run, frame, p1..p6: mean event value per day of each event type, and of all. One run."""
    t = table(spark, sf_dir, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("frame")
    parts = [F.coalesce(F.avg(F.when(F.col("k") == i, F.col("value"))), F.lit(0.0)).alias(f"p{i}") for i in range(1, 6)]
    return t.join(F.broadcast(event_types(t)), "event_type").groupBy(F.lit(0).alias("run"), day).agg(*parts, F.avg("value").alias("p6"))


def event_types(t: DataFrame) -> DataFrame:
    """event_type, k: the few types, numbered in order."""
    kinds = t.select("event_type").distinct()
    return kinds.withColumn("k", F.row_number().over(Window.orderBy("event_type")))


def echoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, echo, te, value: mean price per part and line number; te in ms."""
    t = table(spark, sf_dir, "lineitem")
    return t.groupBy(F.col("l_partkey").alias("node_id"), F.col("l_linenumber").cast("int").alias("echo")).agg(F.avg("l_extendedprice").alias("value")).withColumn("te", F.col("echo") * 10.0)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, label_id, x, y, z (first three components) and voxel index i, j, k (tenths)."""
    t = table(spark, sf_dir, "embeddings")
    xyz = {n: F.col("embedding")[i].cast("double") for i, n in enumerate("xyz")}
    out = t.select(F.col("vec_id").alias("node_id"), F.col("label").alias("label_id"), *[c.alias(n) for n, c in xyz.items()])
    return out.withColumns({n: F.floor(F.col(c) * 10).cast("int") for n, c in zip("ijk", "xyz")})


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, label_id, ts (array of double)."""
    t = table(spark, sf_dir, "embeddings")
    return t.select(F.col("vec_id").alias("node_id"), F.col("label").alias("label_id"), F.col("embedding").cast("array<double>").alias("ts"))


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """component_id, kappa, rho, variance_explained, r2 and classification, from documents and their labels."""
    d, q = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    text = F.coalesce("text", F.lit(""))
    # numbers of the texts first: texts aren't dealt out for the join
    d = d.select("doc_id", "n_chars", (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("double").alias("rho"))
    out = d.join(q, "doc_id", "left").select(
        F.col("doc_id").alias("component_id"),
        (F.col("n_chars") / 10.0).alias("kappa"),
        "rho",
        (F.col("n_chars") % 97 / 10.0).alias("variance_explained"),
        (F.col("n_chars") % 101 / 101.0).alias("r2"),
        (F.col("n_chars") % 7 / 5.0).alias("ratio"),
        F.when(F.col("quality") == 1, " Accepted").when(F.col("quality") == 0, "rejected").otherwise("unclear").alias("classification"),
        (F.coalesce("toxic", F.lit(0)) == 1).alias("manual_reject"),
    )
    return out


#: The same tables as SQL.
CTE = {
    "signal": "signal AS (SELECT l_suppkey AS node_id, ((year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1)::INTEGER AS frame, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)",
    "run_signal": "run_signal AS (SELECT ((day(ts) - 1) // 10)::INTEGER AS run, user_id AS node_id, day(ts)::INTEGER AS frame, avg(value) AS value FROM events GROUP BY 1, 2, 3)",
    "motion": "kinds AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS k FROM (SELECT DISTINCT event_type FROM events)), motion AS (SELECT 0 AS run, date_diff('day', DATE '2024-01-01', ts::DATE)::INTEGER AS frame, "
    + ", ".join(f"coalesce(avg(value) FILTER (k = {i}), 0.0) AS p{i}" for i in range(1, 6))
    + ", avg(value) AS p6 FROM events JOIN kinds USING (event_type) GROUP BY 2)",
    "echoes": "echoes AS (SELECT l_partkey AS node_id, l_linenumber::INTEGER AS echo, avg(l_extendedprice) AS value, l_linenumber * 10.0::DOUBLE AS te FROM lineitem GROUP BY 1, 2, 4)",
    "nodes": "nodes AS (SELECT *, floor(x * 10)::INTEGER AS i, floor(y * 10)::INTEGER AS j, floor(z * 10)::INTEGER AS k FROM (SELECT vec_id AS node_id, label AS label_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings))",
    "vectors": "vectors AS (SELECT vec_id AS node_id, label AS label_id, embedding::DOUBLE[] AS ts FROM embeddings)",
    "components": "components AS (SELECT d.doc_id AS component_id, n_chars / 10.0::DOUBLE AS kappa, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', '')))::DOUBLE AS rho, n_chars % 97 / 10.0::DOUBLE AS variance_explained, n_chars % 101 / 101.0::DOUBLE AS r2, n_chars % 7 / 5.0::DOUBLE AS ratio, CASE quality WHEN 1 THEN ' Accepted' WHEN 0 THEN 'rejected' ELSE 'unclear' END AS classification, coalesce(toxic, 0) = 1 AS manual_reject FROM documents d LEFT JOIN labels q ON d.doc_id = q.doc_id)",
}


def sql(names: str, body: str, more: str = "") -> str:
    """body after the named tables' definitions; more: further definitions."""
    parts = [CTE[n] for n in names.split()] + ([more] if more else [])
    return f"WITH {', '.join(parts)} {body}"
