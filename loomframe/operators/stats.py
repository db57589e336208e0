"""Aggregates over frames, nodes, runs and subjects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scalar(df: DataFrame, *aggregates: Column) -> DataFrame:
    """One row, to be joined to every row."""
    return F.broadcast(df.agg(*aggregates))


def temporal_reduce(signal: DataFrame) -> DataFrame:
    """A1. node_id, mean, sd (sample), low, high over frames."""
    return signal.groupBy("node_id").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.min("value").alias("low"), F.max("value").alias("high"))


def global_signal(signal: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """A2. frame, gs: mean over (masked) nodes."""
    if mask is not None:
        signal = signal.join(mask.select("node_id").distinct(), "node_id", "left_semi")
    return signal.groupBy("frame").agg(F.avg("value").alias("gs"))


def temporal_sd_percent(signal: DataFrame, eps: float = 1e-8) -> DataFrame:
    """A3. 100 * sd / |mean|; 0 where the mean is within eps of 0 or the result isn't finite."""
    m = temporal_reduce(signal)
    out = F.when(F.abs("mean") > eps, 100 * F.col("sd") / F.abs("mean"))
    return m.select("node_id", F.coalesce(F.when(~F.isnan(out), out), F.lit(0.0)).alias("sd_percent"))


def snr_maps(maps: DataFrame) -> DataFrame:
    """A4. From mean, noise_var and signal_var: cov, tsnr and cnr; undefined values are 0."""
    sd = F.sqrt("noise_var")
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return maps.select("node_id", safe(sd, F.col("mean")).alias("cov"), safe(F.col("mean"), sd).alias("tsnr"), safe(F.sqrt("signal_var"), sd).alias("cnr"))


def modal_value(df: DataFrame, col: str, position: str, keys: list[str] | None = None) -> DataFrame:
    """A5, A13. The most frequent value (per key); of equally frequent ones that which was met first, then the smallest."""
    keys = keys or []
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first"))
    best = F.min_by(col, F.struct(-F.col("n"), "first", col)).alias(col)
    return counts.groupBy(*keys).agg(best)


def mean_readout(sidecars: DataFrame) -> DataFrame:
    """A6. ap, pa: mean of the total readout time, else spacing * (lines - 1), per direction; a side without any takes the other's."""
    t = F.coalesce("total", F.col("spacing") * (F.col("lines") - 1))
    one = sidecars.agg(F.avg(F.when(F.col("direction") == "ap", t)).alias("a"), F.avg(F.when(F.col("direction") == "pa", t)).alias("p"))
    return one.select(F.coalesce("a", "p").alias("ap"), F.coalesce("p", "a").alias("pa"))


def total_minutes(runs: DataFrame) -> DataFrame:
    """A7. Frames times TR (2.0 where unknown), in minutes."""
    return runs.agg((F.sum(F.col("n_frames") * F.coalesce("tr", F.lit(2.0))) / 60).alias("minutes"))


def coverage(maps: DataFrame, col: str = "value") -> DataFrame:
    """A8. nonzero, total, percent and whether the map is complete."""
    c = maps.agg(F.count_if(F.coalesce(F.col(col), F.lit(0)) != 0).alias("nonzero"), F.count(F.lit(1)).alias("total"))
    return c.select("nonzero", "total", (100.0 * F.col("nonzero") / F.col("total")).alias("percent"), (F.col("nonzero") == F.col("total")).alias("complete"))


def subcortical_ratio(maps: DataFrame, structures: DataFrame, eps: float = 1e-8) -> DataFrame:
    """A10. Per component the largest mean |loading| of a structure over the cortical mean; infinite if that is 0, NaN without cortex."""
    per = maps.join(structures, "node_id").groupBy("component_id", "structure").agg(F.avg(F.abs("loading")).alias("m"))
    wide = per.groupBy("component_id").agg(F.max(F.when(F.col("structure") == "cortex", F.col("m"))).alias("c"), F.max(F.when(F.col("structure") != "cortex", F.col("m"))).alias("s"))
    ratio = F.when(F.col("c").isNull(), float("nan")).when(F.col("c") <= 0, float("inf")).otherwise(F.col("s") / (F.col("c") + eps))
    return wide.select("component_id", ratio.alias("ratio"))


def parcellate(signal: DataFrame, labels: DataFrame) -> DataFrame:
    """A11. parcel, frame, value: mean series of each label above 0."""
    return signal.join(labels.filter("label_id > 0"), "node_id").groupBy(F.col("label_id").alias("parcel"), "frame").agg(F.avg("value").alias("value"))


def group_average(maps: DataFrame, n_sd: float | None = 3.0, absolute: bool = False) -> DataFrame:
    """A12. node_id, mean, sd, n over subjects, of the values or their absolute values, without those beyond n_sd sample sds of the node's mean (None: all count)."""
    kept = maps.withColumn("value", F.abs("value")) if absolute else maps
    if n_sd is not None:
        w = Window.partitionBy("node_id")
        m, s = F.avg("value").over(w), F.stddev_samp("value").over(w)
        kept = kept.withColumn("ok", F.coalesce(F.abs(F.col("value") - m) <= n_sd * s, F.lit(True))).filter("ok")
    return kept.groupBy("node_id").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.count(F.lit(1)).alias("n"))


def grand_mean_scale(signal: DataFrame, mask: DataFrame, target: float = 10000.0) -> DataFrame:
    """A14. Scaled so that the mean inside the mask is target; negative values become 0."""
    inside = signal.join(mask.select("node_id").distinct(), "node_id", "left_semi")
    return signal.crossJoin(scalar(inside, F.avg("value").alias("_m"))).withColumn("value", F.greatest(F.lit(0.0), F.col("value") * target / F.col("_m"))).drop("_m")


def baseline_rescale(frames: DataFrame, b_max: int) -> DataFrame:
    """A15. Each series scaled to the first series' mean over volumes below b_max."""
    base = frames.groupBy("series").agg(F.avg(F.when(F.col("bval") < b_max, F.col("value"))).alias("_b"))
    first = scalar(base, F.min_by("_b", "series").alias("_f"))
    return frames.join(base, "series").crossJoin(first).withColumn("value", F.col("value") * F.col("_f") / F.col("_b")).drop("_b", "_f")


def robust_band(maps: DataFrame, col: str = "value") -> DataFrame:
    """A16. Rows within a third of a sample sd of the median."""
    c = scalar(maps, F.expr(f"percentile({col}, 0.5)").alias("_m"), F.stddev_samp(col).alias("_s"))
    return maps.crossJoin(c).filter(F.abs(F.col(col) - F.col("_m")) <= F.col("_s") / 3).drop("_m", "_s")


def mad_average(signal: DataFrame, rounds: int = 3) -> DataFrame:
    """A17. node_id, value: average over frames whose mean squared residual is below median + 2 MAD, refined in rounds."""
    kept = signal
    for _ in range(rounds):
        mean = kept.groupBy("node_id").agg(F.avg("value").alias("m"))
        score = signal.join(mean, "node_id").groupBy("frame").agg(F.avg((F.col("value") - F.col("m")) ** 2).alias("s"))
        middle = scalar(score, F.expr("percentile(s, 0.5)").alias("med"))
        dev = score.crossJoin(middle)
        mad = scalar(dev, F.expr("percentile(abs(s - med), 0.5)").alias("mad"))
        good = dev.crossJoin(mad).filter(F.col("s") < F.col("med") + 2 * F.col("mad")).select("frame")
        kept = signal.join(good, "frame", "left_semi")
    return kept.groupBy("node_id").agg(F.avg("value").alias("value"))


def echo_average(echoes: DataFrame) -> DataFrame:
    """A18. Mean over echoes."""
    return echoes.groupBy("node_id").agg(F.avg("value").alias("value"))


def run_mean_maps(signal: DataFrame) -> DataFrame:
    """A19. node_id, mean, vn: means over runs of each run's mean and population sd."""
    per = signal.groupBy("run", "node_id").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("v"))
    return per.groupBy("node_id").agg(F.avg("m").alias("mean"), F.avg("v").alias("vn"))


def qa_sizes(files: DataFrame) -> DataFrame:
    """A20. megabytes and volumes of each echo file."""
    return files.select("series", "echo", (F.col("bytes") / 1e6).alias("megabytes"), "volumes")


def validate_echo_groups(series: DataFrame, n_echoes: int, min_bytes: float, truncate: bool = True) -> DataFrame:
    """A21. series, n, ok, problem, volumes: echoes must be 1..n, with one description, large enough; unequal volumes are cut to the least or refused."""
    g = series.groupBy("series").agg(
        F.sort_array(F.collect_list("echo")).alias("e"), F.count_distinct("description").alias("names"), F.min("bytes").alias("least"),
        F.min("volumes").alias("lo"), F.max("volumes").alias("hi"), F.count(F.lit(1)).alias("n"),
    )
    problem = (
        F.when(F.col("e") != F.sequence(F.lit(1), F.lit(n_echoes)), "echo gap")
        .when(F.col("names") > 1, "descriptions differ")
        .when(F.col("least") < min_bytes, "too small")
        .when(F.lit(not truncate) & (F.col("lo") != F.col("hi")), "volumes differ")
    )
    return g.select("series", "n", problem.isNull().alias("ok"), F.coalesce(problem, F.lit("")).alias("problem"), F.col("lo").alias("volumes"))


def gram(signal: DataFrame) -> DataFrame:
    """A22. i, j, g: products of frames summed over the nodes that have both, i <= j. Null values count as missing.

    Each partition adds up one matrix over its nodes and gives it out once; partial sums are added.
    """
    import numpy as np
    import pyarrow as pa

    known = signal.filter(F.col("value").isNotNull())
    vec = known.groupBy("node_id").agg(F.collect_list(F.struct(F.col("frame").cast("int").alias("frame"), F.col("value").cast("double").alias("value"))).alias("v"))

    def run(batches):
        total, both = np.zeros((0, 0)), np.zeros((0, 0))
        for batch in batches:
            cells = batch.column(0)
            if not len(cells):
                continue
            flat = cells.flatten()
            frame, value = flat.field("frame").to_numpy(zero_copy_only=False), flat.field("value").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy()))
            t = max(len(total), 1 + int(frame.max(initial=-1)))
            m, seen = np.zeros((len(cells), t)), np.zeros((len(cells), t))
            np.add.at(m, (row, frame), value)
            seen[row, frame] = 1
            if t > len(total):
                total, both = (np.pad(x, (0, t - len(x))) for x in (total, both))
            total, both = total + m.T @ m, both + seen.T @ seen
        i, j = np.nonzero(np.triu(both))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "g"])

    return vec.select("v").mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))


def outer_sums(rows: DataFrame, left: str, right: str):
    """The matrix of sums over rows of left[i] * right[j], two array columns of fixed lengths, on the driver. One partial matrix a partition; the driver
    gets one number for each cell."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                a, b = (batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for k in (0, 1))
                total = a.T @ b if total is None else total + a.T @ b
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())], ["i", "j", "g"])

    cells = rows.select(F.col(left).cast("array<double>").alias("l"), F.col(right).cast("array<double>").alias("r")).mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect()
    out = np.zeros((1 + max(r["i"] for r in cells), 1 + max(r["j"] for r in cells)))
    for r in cells:
        out[r["i"], r["j"]] = r["g"]
    return out


def wide_maps(maps: DataFrame, key: str, value: str) -> tuple[list, DataFrame]:
    """(the keys in order, node_id with an array of the node's values in that order, 0 where it has none)."""
    keys = [r[key] for r in maps.select(key).distinct().orderBy(key).collect()]
    filled = maps.groupBy("node_id").pivot(key, keys).agg(F.first(value)).na.fill(0.0)
    return keys, filled.select("node_id", F.array(*[F.col(f"`{k}`").cast("double") for k in keys]).alias("a"))


def residual_variance_ratio(stages: DataFrame, columns: list[str], original: str) -> DataFrame:
    """A23. Per node the variance of each stage's column over the original's; undefined ones are 0."""
    v = stages.groupBy("node_id").agg(*[F.var_samp(c).alias(c) for c in [original, *columns]])
    return v.select("node_id", *[F.coalesce(F.try_divide(F.col(c), F.col(original)), F.lit(0.0)).alias(c) for c in columns])


def normalise_by_mean(maps: DataFrame, mask: DataFrame | None = None, col: str = "value") -> DataFrame:
    """A24. Divided by the mean (inside the mask)."""
    inside = maps if mask is None else maps.join(mask.select("node_id").distinct(), "node_id", "left_semi")
    return maps.crossJoin(scalar(inside, F.avg(col).alias("_m"))).withColumn(col, F.col(col) / F.col("_m")).drop("_m")


def stack_modalities(maps: DataFrame, weights: DataFrame) -> DataFrame:
    """A25. Maps (modality, map, node_id, value) divided by their modality's mean sd, times the modality's weight and the first one's sd."""
    sd = maps.groupBy("modality", "map").agg(F.stddev_samp("value").alias("s")).groupBy("modality").agg(F.avg("s").alias("_s"))
    first = scalar(sd, F.min_by("_s", "modality").alias("_f"))
    return maps.join(sd, "modality").join(weights, "modality").crossJoin(first).withColumn("value", F.col("value") / F.col("_s") * F.col("weight") * F.col("_f")).drop("_s", "_f", "weight")
