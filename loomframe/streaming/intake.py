"""Incremental intake as Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.operators.frames import MOTION, RADIUS, ROTATIONS
from loomframe.operators.masks import check_series, classify_series


def earlier_series(spark: SparkSession, out: str, sessions: list, schema: str, before: int) -> DataFrame | None:
    """series that batches before a number have taken in, of the sessions listed only: their folders are named one by one, so what is listed and read follows those
    sessions and not the history. None, if they have no folder yet."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    # folders are named as the writer escapes them
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    paths = [f"{out}/series/session={escape(str(s))}" if s is not None else f"{out}/series/session=__HIVE_DEFAULT_PARTITION__" for s in sessions]
    there = [p for p in paths if (path := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(path)]
    if not there:
        return None
    return spark.read.option("basePath", f"{out}/series").schema(schema).parquet(*there).filter(F.col("batch") < before).select("series").distinct()


def intake_sessions(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, min_bytes: float = 0.0, rules: list[tuple[str, str, str]] | None = None, session: str = "0", files_per_batch: int | None = None) -> None:
    """R1. Series files that weren't seen before are classified, checked and appended once; runs until all available files are in.

    Series with a violation go to the violations, with the reason; all others of the batch are appended. A series that an earlier batch has taken in is a violation
    too; session, an SQL expression over the series' columns, tells where to look: accepted series lie in a folder for each session and batch, and a batch reads the folders of
    its own sessions (so a series keeps its session). A batch that is repeated after a failure replaces its own folders. Rules of classification are
    ``rules``, else the protocol's.
    """

    def batch(df: DataFrame, number: int) -> None:
        df = df.withColumn("session", F.expr(session).cast("string")).persist()
        try:
            series = classify_series(df, rules)
            bad = check_series(series, min_bytes, None, {}).filter("problem <> 'unknown role'")
            if number:
                kind = dict(df.dtypes)["series"]
                sessions = [r["session"] for r in df.select("session").distinct().collect()]
                # what this batch wrote before a failure doesn't count
                earlier = earlier_series(spark, out, sessions, f"series {kind}, session string, batch int", number)
                if earlier is not None:
                    bad = bad.unionByName(series.join(earlier, "series", "left_semi").select("series", F.lit("already taken in").alias("problem")).distinct())
            bad.write.mode("overwrite").parquet(f"{out}/violations/batch={number}")
            good = series.join(bad.select("series").distinct(), "series", "left_anti").withColumn("batch", F.lit(number))
            good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session", "batch").parquet(f"{out}/series")
        finally:
            df.unpersist()

    reader = spark.readStream.schema(schema)
    stream = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _displacements(values: np.ndarray, before: np.ndarray, steps: int) -> np.ndarray:
    """Displacement of each row of values (frames x 6, in order) to the row steps before, which may be among the last rows that went before; 0 without one."""
    rows = np.vstack([before, values])
    step = np.abs(rows[steps:] - rows[:-steps]) if len(rows) > steps else np.zeros((0, 6))
    turn = len(ROTATIONS)
    fd = step[:, turn:].sum(1) + RADIUS * step[:, :turn].sum(1)
    return np.concatenate([np.zeros(len(rows) - len(fd)), fd])[len(before) :]


def censor_stream(motion: DataFrame, threshold: float, steps: int = 1, delay_minutes: int = 60) -> DataFrame:
    """R2. run, frame, fd, keep of arriving motion frames (run, frame, ts, p1..p6), in the order of frames, however they arrive within the delay.

    Frames wait in the run's state until the watermark (the latest ts less the delay) has passed their ts; then they come out in order, with their displacement to the
    frame that came out steps before. So a frame that arrives batches after its successor still stands before it. One that is later than the delay is dropped by the
    watermark. A timer on the earliest waiting frame brings the rest out when only other runs go on. A run without waiting frames keeps its last steps
    frames until the watermark has passed them by the delay once more. ts must rise with frame within a run; of a frame that arrives twice the first one counts.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        wait, last, done = [np.array(x, float) for x in state.get] if state.exists else (np.zeros(0), np.zeros(0), np.full(2, -np.inf))
        rows, last = wait.reshape(-1, 8), last.reshape(-1, 6)
        if not state.hasTimedOut:
            new = pd.concat(list(batches))
            at = new["ts"].to_numpy("datetime64[ms]").astype(np.int64).astype(float)
            rows = np.vstack([rows, np.column_stack([new["frame"].to_numpy(float), at, new[list(MOTION)].to_numpy(float)])])
        mark = state.getCurrentWatermarkMs()
        rows = rows[rows[:, 0] > done[0]]
        rows = rows[np.unique(rows[:, 0], return_index=True)[1]]
        ready, rows = rows[rows[:, 1] <= mark], rows[rows[:, 1] > mark]
        if len(ready):
            fd = _displacements(ready[:, 2:], last, steps)
            last, done = np.vstack([last, ready[:, 2:]])[-steps:], ready[-1, :2]
            yield pd.DataFrame({"run": key[0], "frame": ready[:, 0].astype(int), "fd": fd, "keep": fd < threshold})
        if state.hasTimedOut and not len(rows) and not len(ready):
            state.remove()
            return
        state.update((rows.ravel().tolist(), last.ravel().tolist(), done.tolist()))
        # the earliest frame that waits, or the end of the run; beyond the watermark in any case
        state.setTimeoutTimestamp(int(max(rows[:, 1].min() if len(rows) else done[1] + delay_minutes * 60_000, mark + 1)))

    marked = motion.withWatermark("ts", f"{delay_minutes} minutes")
    return marked.groupBy("run").applyInPandasWithState(step, "run int, frame int, fd double, keep boolean", "wait array<double>, last array<double>, done array<double>", "append", GroupStateTimeout.EventTimeTimeout)
