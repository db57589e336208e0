"""Writers of signals, tables, manifests and incremental output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_signal(signal: DataFrame, path: str) -> None:
    """S10. Single-precision values, a folder for each run."""
    signal.withColumn("value", F.col("value").cast("float")).write.mode("overwrite").partitionBy("run").parquet(path)


def write_table(df: DataFrame, path: str, kind: str = "tsv", digits: int = 8) -> None:
    """S11. TSV with fixed digits, or JSON lines."""
    if kind == "json":
        df.write.mode("overwrite").json(path)
        return
    text = {c: F.format_string(f"%.{digits}f", F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    df.withColumns(text).write.mode("overwrite").csv(path, sep="\t", header=True)


def manifest(series: DataFrame, prefix: str) -> DataFrame:
    """S12. A row for each classified series with its destination and the reason."""
    place = F.concat(F.lit(prefix), F.lit("/"), F.col("role"), F.lit("/series_"), F.col("series").cast("string"))
    return series.select("series", "role", F.when(F.col("role").isin("ignore", "unknown"), None).otherwise(place).alias("destination"), "reason")


def write_manifest(series: DataFrame, path: str, prefix: str) -> None:
    manifest(series, prefix).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_incremental(df: DataFrame, path: str, start_session: int) -> None:
    """S13. From session 1 everything is written anew; a later start replaces the sessions that df has and leaves the others, so that a repeated write
    adds nothing. df has a column session."""
    writer = df.write.mode("overwrite").partitionBy("session")
    (writer if start_session <= 1 else writer.option("partitionOverwriteMode", "dynamic")).parquet(path)
