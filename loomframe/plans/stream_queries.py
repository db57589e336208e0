"""Queries that run streams over the driver's tables until all available data is in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from loomframe.operators.frames import MOTION, framewise_displacement
from loomframe.plans.adapters import motion, rounded, sql
from loomframe.plans.frame_queries import _FD
from loomframe.plans.mask_queries import SERIES_SQL, URL_RULES
from loomframe.plans.registry import query
from loomframe.sources import readers, sinks
from loomframe.streaming import intake


def scratch(spark) -> str:
    """A new folder that driver and executors share; a local session may use its own disk."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/{uuid.uuid4().hex}"


@query("R1_intake_sessions", f"SELECT page_id AS series, {SERIES_SQL} AS role FROM pages")
def _(spark, d):
    at = scratch(spark)
    t = spark.read.parquet(f"{d}/pages.parquet").select(F.col("page_id").alias("series"), F.col("url").alias("description"), F.length("html").cast("long").alias("bytes"), F.lit(1).alias("volumes"))
    # two deliveries; the second brings a part of the first again
    for part in (F.col("series") % 3 > 0, F.col("series") % 3 < 2):
        t.filter(part).write.mode("append").parquet(f"{at}/in")
        intake.intake_sessions(spark, f"{at}/in", t.schema.simpleString()[len("struct<") : -1].replace(":", " "), f"{at}/out", f"{at}/marks", rules=URL_RULES, session="series % 20")
    return spark.read.parquet(f"{at}/out/series").select("series", "role")


@query("R2_censor_stream", sql("motion", f"SELECT run, frame, round({_FD} + 1e-9, 6) + 0.0 AS fd, {_FD} < 1000 AS keep FROM motion"))
def _(spark, d):
    at = scratch(spark)
    m = motion(spark, d).withColumns({"run": F.col("run").cast("int"), "frame": F.col("frame").cast("int"), "ts": F.timestamp_seconds(F.lit(1704067200) + F.col("frame") * 86400)}).select("run", "frame", "ts", *MOTION)
    m.write.parquet(f"{at}/all")
    m = spark.read.schema(m.schema).parquet(f"{at}/all")
    # frames arrive out of order, up to three days late; a frame of another run, long after, lets the watermark pass the last ones
    late = F.when(F.col("frame") % 4 == 1, F.col("frame") + 3).otherwise(F.col("frame"))
    end = m.groupBy().agg(F.lit(-1).alias("run"), F.lit(0).alias("frame"), (F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts"), *[F.lit(0.0).alias(p) for p in MOTION])
    for arrival in (m.filter(late < 15), m.filter(late >= 15), end):
        arrival.write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(m.schema).parquet(f"{at}/in")
        out = intake.censor_stream(stream, 1000.0, delay_minutes=4 * 1440)
        out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/marks").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.read.schema("run int, frame int, fd double, keep boolean").parquet(f"{at}/out"), "fd")


@query("S11_write_table", "SELECT o_orderkey, printf('%.8f', o_totalprice) AS o_totalprice FROM orders")
def _(spark, d):
    at = scratch(spark)
    sinks.write_table(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_totalprice"), at)
    return spark.read.schema("o_orderkey bigint, o_totalprice string").csv(at, sep="\t", header=True)


@query("S13_write_incremental", sql("motion", f"SELECT frame % 3 + 1 AS session, frame, round({_FD} + 1e-9, 6) + 0.0 AS fd FROM motion"))
def _(spark, d):
    at = scratch(spark)
    fd = rounded(framewise_displacement(motion(spark, d)), "fd").select((F.col("frame") % 3 + 1).alias("session"), "frame", "fd")
    for s in (1, 2, 3):
        sinks.write_incremental(fd.filter(F.col("session") == s), at, s)
    return spark.read.schema("frame int, fd double, session int").parquet(at)


@query("S14_run_metadata", "SELECT 'rows' AS key, count(*)::VARCHAR AS value FROM lineitem UNION ALL SELECT 'tr', '2.0'")
def _(spark, d):
    return readers.run_metadata(spark, {"tr": 2.0, "rows": spark.read.parquet(f"{d}/lineitem.parquet").count()})
