"""Frame operators: motion, derivatives, censoring, detrending, run bookkeeping."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROTATIONS, TRANSLATIONS = ("p1", "p2", "p3"), ("p4", "p5", "p6")
MOTION = (*ROTATIONS, *TRANSLATIONS)
#: Radius in mm that turns rotations into arc lengths.
RADIUS = 50.0


def in_order(*keys: str):
    return Window.partitionBy(*keys).orderBy("frame")


def framewise_displacement(motion: DataFrame, tr: float = 2.0) -> DataFrame:
    """W1. run, frame, fd against the frame 2.5 s before (half-even rounded to frames, between 1 and the run's length)."""
    steps = max(1, round(2.5 / tr))
    n = F.count(F.lit(1)).over(Window.partitionBy("run"))
    w = in_order("run")
    total = lambda names: sum((F.abs(F.col(p) - F.lag(p, steps).over(w)) for p in names), F.lit(0.0))
    fd = F.when(n > steps, total(TRANSLATIONS) + RADIUS * total(ROTATIONS))
    return motion.select("run", "frame", F.coalesce(fd, F.lit(0.0)).alias("fd"))


def fd_from_derivatives(motion: DataFrame) -> DataFrame:
    """W2. Displacement from one-frame derivatives; translations first (p1-p3), rotations p4-p6 in degrees."""
    d = backward_difference(motion, list(MOTION), ["run"])
    fd = sum((F.abs(f"d_{p}") for p in ROTATIONS), F.lit(0.0)) + RADIUS * math.pi / 180 * sum((F.abs(f"d_{p}") for p in TRANSLATIONS), F.lit(0.0))
    return d.select("run", "frame", fd.alias("fd"))


def backward_difference(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """W3. d_<col>: x(t) - x(t-1), 0 at the first frame."""
    w = in_order(*keys)
    return df.withColumns({f"d_{c}": F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0.0)) for c in cols})


def central_difference(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """W4. d_<col>: half the difference of the neighbours; one-sided at both ends."""
    w = in_order(*keys)

    def one(c: str) -> Column:
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        return F.when(before.isNull(), after - F.col(c)).when(after.isNull(), F.col(c) - before).otherwise((after - before) / 2)

    return df.withColumns({f"d_{c}": F.coalesce(one(c), F.lit(0.0)) for c in cols})


def dvars(signal: DataFrame) -> DataFrame:
    """W5. frame, dvars: root mean square over nodes of backward differences, minus their median; 0 at the first frame."""
    w = in_order("node_id")
    d = signal.withColumn("d", F.col("value") - F.lag("value").over(w))
    per = d.groupBy("frame").agg(F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rms"))
    middle = per.agg(F.expr("percentile(rms, 0.5)").alias("m"))
    first = per.agg(F.min("frame").alias("f0"))
    return per.crossJoin(F.broadcast(middle)).crossJoin(F.broadcast(first)).select("frame", F.when(F.col("frame") == F.col("f0"), 0.0).otherwise(F.col("rms") - F.col("m")).alias("dvars"))


def demean_runs(signal: DataFrame, scale: bool = False, eps: float = 0.0) -> DataFrame:
    """W6. value minus the mean of (run, node); scale divides by the population sd where that exceeds eps."""
    w = Window.partitionBy("run", "node_id")
    out = F.col("value") - F.avg("value").over(w)
    if scale:
        sd = F.stddev_pop("value").over(w)
        out = out / F.when(sd > eps, sd).otherwise(1.0)
    return signal.withColumn("value", out)


def standardise(df: DataFrame, cols: list[str], keys: list[str], sample: bool = False, floor: float = 0.0) -> DataFrame:
    """W7. z-scores; population sd with 0 taken as 1, or sample sd floored. Non-finite results are 0."""
    w = Window.partitionBy(*keys)

    def one(c: str) -> Column:
        sd = F.stddev_samp(c).over(w) if sample else F.stddev_pop(c).over(w)
        sd = F.greatest(sd, F.lit(floor)) if sample else F.when(sd > 0, sd).otherwise(1.0)
        z = F.try_divide(F.col(c) - F.avg(c).over(w), sd)
        return F.when(z.isNull() | F.isnan(z) | (F.abs(z) == float("inf")), 0.0).otherwise(z)

    return df.withColumns({c: one(c) for c in cols})


def expand_motion24(motion: DataFrame) -> DataFrame:
    """W8. Six parameters and derivatives, normalised; and the squares of these, normalised (sample sd, floor 1e-5)."""
    base = backward_difference(motion, list(MOTION), ["run"]).select("run", "frame", *MOTION, *[f"d_{p}" for p in MOTION])
    twelve = [c for c in base.columns if c not in ("run", "frame")]
    norm = standardise(base, twelve, ["run"], sample=True, floor=1e-5)
    squares = norm.withColumns({f"{c}_sq": F.col(c) * F.col(c) for c in twelve})
    return standardise(squares, [f"{c}_sq" for c in twelve], ["run"], sample=True, floor=1e-5)


def linear_detrend(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """W9. Removes mean and slope over equally spaced positions -1..1, in frame order."""
    w, whole = in_order(*keys), Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(whole)
    x = F.when(n > 1, 2.0 * (F.row_number().over(w) - 1) / (n - 1) - 1).otherwise(0.0)
    df = df.withColumns({"_x": x, "_sxx": F.when(n > 1, n * (n + 1) / (3.0 * (n - 1))).otherwise(1.0)})
    out = {c: F.col(c) - F.avg(c).over(whole) - F.col("_x") * F.sum(F.col("_x") * F.col(c)).over(whole) / F.col("_sxx") for c in cols}
    return df.withColumns(out).drop("_x", "_sxx")


def censor(signal: DataFrame, fd: DataFrame, threshold: float, enabled: bool = True) -> DataFrame:
    """P7. Frames with fd strictly below the threshold."""
    return signal.join(fd.filter(F.col("fd") < threshold).select("frame"), "frame", "left_semi") if enabled else signal


def excise_frames(signal: DataFrame, keep: DataFrame) -> DataFrame:
    """P8. Frames that keep marks true."""
    return signal.join(keep.filter("keep").select("frame"), "frame", "left_semi")


def drop_initial(signal: DataFrame, n: int = 10) -> DataFrame:
    """P9. Without the first n frames; frames count from 0 again."""
    return signal.filter(F.col("frame") >= n).withColumn("frame", F.col("frame") - n)


def run_extent(runs: DataFrame) -> DataFrame:
    """W12. run, start, stop (exclusive) of each run in the concatenation; empty runs keep start = stop."""
    w = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_frames").over(w), F.lit(0))
    return runs.select("run", start.alias("start"), (start + F.col("n_frames")).alias("stop"))


def scan_index(frames: DataFrame) -> DataFrame:
    """W13. scan: 1..R in (session, run) order; numbered on the few distinct runs, then joined."""
    runs = frames.select("session", "run").distinct().withColumn("scan", F.row_number().over(Window.orderBy("session", "run")))
    return frames.join(runs, ["session", "run"])


def renumber(labels: DataFrame, col: str = "label") -> DataFrame:
    """W14. number: 1.. over the distinct labels, numeric ones first in numeric order, then text."""
    kinds = labels.select(col).distinct().withColumn("_n", F.expr(f"CASE WHEN {col} RLIKE '^[0-9]+$' THEN try_cast({col} AS BIGINT) END"))
    order = Window.orderBy(F.col("_n").isNull(), "_n", col)
    return kinds.select(col, F.row_number().over(order).alias("number"))


def slice_timing(times: DataFrame, multiband: int = 1) -> DataFrame:
    """W15. series, slice, shift: (place of the reference - own place) / n over the first n = slices / multiband times.

    The reference is the slice at place n / 2 (half up). Each band repeats the shifts.
    """
    e = times.select("series", F.posexplode("times").alias("pos", "time"), F.floor(F.size("times") / multiband).cast("int").alias("n"))
    e = e.filter(F.col("pos") < F.col("n"))
    place = e.withColumn("place", F.row_number().over(Window.partitionBy("series").orderBy("time", "pos")) - 1)
    shift = (F.floor(F.col("n") / 2.0 + 0.5).cast("int") - 1 - F.col("place")) / F.col("n")
    bands = F.explode(F.sequence(F.lit(0), F.lit(multiband - 1))).alias("band")
    return place.withColumn("shift", shift).select("series", "pos", "n", "shift", bands).select("series", (F.col("band") * F.col("n") + F.col("pos")).alias("slice"), "shift")


def echo_size_trend(files: DataFrame) -> DataFrame:
    """W16. Echoes that aren't larger than the next, and series whose first echo isn't larger than the last."""
    w = Window.partitionBy("series").orderBy("echo")
    step = files.withColumn("next", F.lead("size").over(w)).filter("size <= next").select("series", "echo", F.lit("not larger than the next").alias("warning"))
    ends = files.groupBy("series").agg(F.min_by("size", "echo").alias("a"), F.max_by("size", "echo").alias("b"), F.count(F.lit(1)).alias("n"))
    return step.unionByName(ends.filter("n > 1 AND a <= b").select("series", F.lit(0).alias("echo"), F.lit("first not larger than the last").alias("warning")))


def settled(df: DataFrame) -> DataFrame:
    """df computed once, its lineage cut: a checkpoint in the folder that the session names. A local session without one gets a folder of its own."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return df.checkpoint()


def in_total_order(df: DataFrame, order: list[Column], value: str | None = None) -> DataFrame:
    """Adds _position (from 1, in the order given) and, for a value, _before: its sum over all rows before. The order must be total.

    Rows are dealt to ranges and numbered inside them; a range's offsets come from the counts and sums of the ranges before it, of which there are as
    many as shuffle partitions. No task gets all rows.
    """
    parts = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    amount = F.col(value) if value else F.lit(0.0)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s"))
    offsets = sums.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(earlier), F.lit(0.0)).alias("_s0"))
    inside = Window.partitionBy("_part").orderBy("_at")
    out = parts.withColumns({"_position": F.row_number().over(inside), "_before": F.coalesce(F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))}).join(offsets, "_part")
    out = out.withColumns({"_position": (F.col("_position") + F.col("_n0")).cast("int"), "_before": F.col("_before") + F.col("_s0")}).drop("_at", "_part", "_n0", "_s0")
    return out if value else out.drop("_before")


def cumulative_cap(df: DataFrame, value: str, score: str, key: str, cap: float) -> DataFrame:
    """W17. kept: rows by falling score while the sum before them is within cap of the total; all if the total isn't positive."""
    total = df.agg(F.sum(value).alias("_total"))
    placed = in_total_order(df, [F.desc(score), F.asc(key)], value)
    return placed.crossJoin(F.broadcast(total)).withColumn("kept", (F.col("_total") <= 0) | (F.col("_before") <= cap * F.col("_total"))).drop("_total", "_before", "_position")


def spaced_baselines(frames: DataFrame, b_max: int, distance: int) -> DataFrame:
    """W18. series, vol, pick: the last volume picked so far; a volume below b_max is picked if distance from the last pick, -1 before any."""
    ordered = frames.groupBy("series").agg(F.array_sort(F.collect_list(F.struct("vol", "bval"))).alias("v"))
    start = F.expr("named_struct('last', -1, 'out', cast(array() as array<struct<vol:int,pick:int>>))")

    def step(acc: Column, x: Column) -> Column:
        picked = (x["bval"] < b_max) & ((acc["last"] < 0) | (x["vol"] - acc["last"] >= distance))
        last = F.when(picked, x["vol"]).otherwise(acc["last"])
        return F.struct(last.alias("last"), F.concat(acc["out"], F.array(F.struct(x["vol"].alias("vol"), last.alias("pick")))).alias("out"))

    return ordered.select("series", F.inline(F.aggregate("v", start, step)["out"]))


def demean_regressors(motion: DataFrame) -> DataFrame:
    """W19. Motion columns minus their mean in the run."""
    w = Window.partitionBy("run")
    return motion.withColumns({p: F.col(p) - F.avg(p).over(w) for p in MOTION})


def concat_runs(signal: DataFrame) -> DataFrame:
    """U1. Demeaned runs on one time axis: global_frame counts over all runs in order, scan numbers the runs."""
    runs = signal.select("run", "frame").distinct().groupBy("run").agg(F.count(F.lit(1)).alias("n_frames"), F.min("frame").alias("f0"))
    extent = run_extent(runs).withColumn("scan", F.row_number().over(Window.orderBy("run")))
    placed = demean_runs(signal).join(extent.join(runs.select("run", "f0"), "run"), "run")
    return placed.select("scan", "node_id", (F.col("start") + F.col("frame") - F.col("f0")).cast("int").alias("global_frame"), "value")


def frames_of(extent: DataFrame) -> DataFrame:
    """extent with one row for each frame of a run, as global_frame: ranges become equal keys. Empty runs have none."""
    some = extent.filter("stop > start")
    return some.withColumn("global_frame", F.explode(F.sequence(F.col("start").cast("int"), (F.col("stop") - 1).cast("int"))))


def split_runs(concat: DataFrame, extent: DataFrame, means: DataFrame) -> DataFrame:
    """U2. The concatenation cut back into runs, with each node's run mean added again."""
    cut = concat.join(frames_of(extent), "global_frame").select("run", "node_id", (F.col("global_frame") - F.col("start")).alias("frame"), "value")
    return cut.join(means, ["run", "node_id"]).withColumn("value", F.col("value") + F.col("mean")).drop("mean")
