"""Projections, filters and predicates over nodes, frames, series and components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ordered rules of series classification: (role, regular expression over the description, reason).
SERIES_RULES = [
    ("ignore", r"(localizer|scout|phoenix)", "ignored by pattern"),
    ("t1w", r"(t1w|mprage)", "T1-weighted"),
    ("t2w", r"(t2w|space)", "T2-weighted"),
    ("ap", r"_ap", "field map AP"),
    ("pa", r"_pa", "field map PA"),
    ("sbref", r"sbref", "single-band reference"),
    ("rest", r"(rest|bold)", "resting run"),
]
#: Fixed labels of a kept component.
KEPT_LABELS = ("accepted", "provisionalaccept")
PHASE_DIRECTIONS = ("i", "i-", "j", "j-", "k", "k-")


def map_math(maps: list[tuple[str, DataFrame]], expression: str) -> DataFrame:
    """P1. node_id, value: an expression over aligned maps, each (node_id, value), named as given."""
    name, out = maps[0]
    out = out.select("node_id", F.col("value").alias(name))
    for name, m in maps[1:]:
        out = out.join(m.select("node_id", F.col("value").alias(name)), "node_id")
    return out.select("node_id", F.expr(expression).alias("value"))


def threshold(df: DataFrame, low: float, high: float, binarise: bool = False, invert: bool = False, col: str = "value") -> DataFrame:
    """P2. Values outside [low, high] become 0; binarise: the others 1; invert: the other way round."""
    inside = F.col(col).between(low, high)
    if invert:
        return df.withColumn(col, F.when(inside & (F.col(col) != 0), 0.0).otherwise(1.0))
    return df.withColumn(col, F.when(inside, F.lit(1.0) if binarise else F.col(col)).otherwise(0.0))


def apply_mask(df: DataFrame, mask: DataFrame, drop: bool = True) -> DataFrame:
    """P3. Nodes of the mask; without drop the others stay with value 0."""
    m = mask.select("node_id").distinct()
    if drop:
        return df.join(m, "node_id", "left_semi")
    return df.join(m.withColumn("_in", F.lit(True)), "node_id", "left").withColumn("value", F.when(F.col("_in"), F.col("value")).otherwise(0.0)).drop("_in")


def label_mask(nodes: DataFrame, ids: list[int], col: str = "label_id") -> DataFrame:
    """P4. node_id of nodes whose rounded label is listed."""
    return nodes.filter(F.rint(col).cast("int").isin(ids)).select("node_id")


def label_import(df: DataFrame, lut: DataFrame) -> DataFrame:
    """P5. Rows whose label is in the lookup table, with its name."""
    return df.join(lut.select("label_id", "name"), "label_id")


def select_structures(nodes: DataFrame, names: list[str], bad: list[int] | None = None, prefix: str = "CIFTI_STRUCTURE_") -> DataFrame:
    """P6. Nodes of the listed structures (all, if none is listed), without the 1-based bad ids."""
    s = F.upper(F.regexp_replace("structure", f"^{prefix}", ""))
    out = nodes.withColumn("structure", s)
    if names:
        out = out.filter(F.col("structure").isin([n.upper() for n in names]))
    return out.filter(~F.col("node_id").isin([b - 1 for b in bad])) if bad else out


def nonzero_nodes(signal: DataFrame) -> DataFrame:
    """P10. node_id of nodes that change over time."""
    return signal.groupBy("node_id").agg((F.max("value") - F.min("value")).alias("r")).filter("r > 0").select("node_id")


def classify_series(series: DataFrame, rules: list[tuple[str, str, str]] | None = None, col: str = "description") -> DataFrame:
    """P11. role and reason: of the first rule whose pattern occurs (any case), else unknown."""
    role = reason = None
    for name, pattern, why in rules or SERIES_RULES:
        hit = F.lower(col).rlike(pattern)
        role = F.when(hit, name) if role is None else role.when(hit, name)
        reason = F.when(hit, why) if reason is None else reason.when(hit, why)
    return series.withColumns({"role": role.otherwise("unknown"), "reason": reason.otherwise("no rule matched")})


def initial_keep(components: DataFrame) -> DataFrame:
    """P12. keep: the trimmed lower-case classification is a kept one."""
    return components.withColumn("keep", F.coalesce(F.lower(F.trim("classification")).isin(*KEPT_LABELS), F.lit(False)))


def select_dwi_vols(frames: DataFrame, bvals: list[int], delta: int = 100) -> DataFrame:
    """P13. Volumes within delta of one of the b values."""
    hit = F.lit(False)
    for b in bvals:
        hit = hit | (F.abs(F.col("bval").cast("int") - b) < delta)
    return frames.filter(hit)


def subset_components(maps: DataFrame, ids: list[int]) -> DataFrame:
    """P14. The listed maps, numbered in list order; unknown ids drop out; if none is left, one map of zeros."""
    spark = maps.sparkSession
    order = spark.createDataFrame([(c, k) for k, c in enumerate(ids)], "component_id int, position int")
    hit = maps.join(F.broadcast(order), "component_id").select("position", "node_id", "loading")
    if hit.isEmpty():
        return maps.select("node_id").distinct().select(F.lit(0).alias("position"), "node_id", F.lit(0.0).alias("loading"))
    return hit


def check_series(series: DataFrame, min_bytes: float, volumes: int | None, per_role: dict[str, int]) -> DataFrame:
    """P15. series, problem: one row for each violation."""
    parts = [
        series.filter(F.col("bytes") < min_bytes).select("series", F.lit("too small").alias("problem")),
        series.filter("role = 'unknown'").select("series", F.lit("unknown role").alias("problem")),
        series.groupBy("series").count().filter("count > 1").select("series", F.lit("number used twice").alias("problem")),
    ]
    if volumes is not None:
        parts.append(series.filter(F.col("volumes") != volumes).select("series", F.lit("wrong volume count").alias("problem")))
    for role, most in per_role.items():
        many = series.filter(F.col("role") == role).agg(F.min("series").alias("series"), F.count(F.lit(1)).alias("n"))
        parts.append(many.filter(F.col("n") > most).select("series", F.lit(f"too many {role}").alias("problem")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_sidecars(sidecars: DataFrame, required: list[str], arrays: list[str], direction: str | None = None) -> DataFrame:
    """P16. path, problem of JSON bodies: missing keys, keys that aren't arrays, unknown phase directions."""
    value = {k: F.get_json_object("body", f"$.{k}") for k in [*required, *arrays, *([direction] if direction else [])]}
    problems = [F.when(value[k].isNull(), f"missing {k}") for k in required]
    problems += [F.when(value[k].isNotNull() & ~value[k].startswith("["), f"{k} is not an array") for k in arrays]
    if direction:
        problems.append(F.when(value[direction].isNotNull() & ~value[direction].isin(*PHASE_DIRECTIONS), "bad direction"))
    return sidecars.select("path", F.explode(F.array_compact(F.array(*problems))).alias("problem"))


def good_nodes(cov: DataFrame, smooth: DataFrame, k: float = 0.5) -> DataFrame:
    """P17. node_id, good: the coefficient of variation over its smoothed value isn't above mean + k * sd of that ratio."""
    ratio = cov.join(smooth.select("node_id", F.col("value").alias("s")), "node_id").select("node_id", F.try_divide("value", "s").alias("r"))
    limits = ratio.agg((F.avg("r") + k * F.stddev_samp("r")).alias("limit"))
    return ratio.crossJoin(F.broadcast(limits)).select("node_id", F.coalesce(F.col("r") <= F.col("limit"), F.lit(False)).alias("good"))


def short_echo(echoes: DataFrame, te_max: float = 60.0) -> DataFrame:
    """P18. Echoes with TE below te_max, compared as numbers."""
    return echoes.filter(F.col("te").cast("double") < te_max)


def fov_mask(signal: DataFrame) -> DataFrame:
    """P19. node_id of nodes with data in every frame."""
    return signal.groupBy("node_id").agg(F.min(F.abs("value")).alias("m")).filter("m > 0").select("node_id")


def bias_revert(signal: DataFrame, old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """P20. Values times the old bias map over the new one; each is optional."""
    out = signal
    for m, f in ((old, lambda v, b: v * b), (new, lambda v, b: v / b)):
        if m is not None:
            out = out.join(m.select("node_id", F.col("value").alias("_b")), "node_id").withColumn("value", f(F.col("value"), F.col("_b"))).drop("_b")
    return out


def mask_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """U3."""
    return a.select("node_id").union(b.select("node_id")).distinct()


def mask_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """U3."""
    return a.select("node_id").intersect(b.select("node_id"))


def mask_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """U3."""
    return a.select("node_id").subtract(b.select("node_id"))


def merge_labels(orig: DataFrame, aux: DataFrame, agree: list[int], from_aux: list[int], dropped: int) -> DataFrame:
    """U4. Labels in agree stay only where both sources have them; those in from_aux come from aux; dropped becomes 0."""
    j = orig.select("node_id", F.col("label_id").alias("o")).join(aux.select("node_id", F.col("label_id").alias("a")), "node_id", "full")
    label = F.when(F.col("a").isin(from_aux), F.col("a")).when(F.col("o").isin(agree) & ~F.col("o").eqNullSafe(F.col("a")), 0).when(F.col("o") == dropped, 0).otherwise(F.coalesce("o", F.lit(0)))
    return j.select("node_id", label.cast("int").alias("label_id"))


def partition_components(components: DataFrame, noise: DataFrame) -> DataFrame:
    """U5. kind: noise for the listed ids, signal for all others."""
    n = noise.select("component_id").distinct()
    return components.join(n, "component_id", "left_anti").withColumn("kind", F.lit("signal")).unionByName(components.join(n, "component_id", "left_semi").withColumn("kind", F.lit("noise")))


def check_continuity(images: DataFrame, sidecars: DataFrame) -> DataFrame:
    """U6. series, missing_images, missing_sidecars against echoes 1..N, N being the largest echo of either."""
    a = images.groupBy("series").agg(F.collect_set("echo").alias("a"))
    b = sidecars.groupBy("series").agg(F.collect_set("echo").alias("b"))
    none = F.expr("cast(array() as array<int>)")
    j = a.join(b, "series", "full").withColumns({"a": F.coalesce("a", none), "b": F.coalesce("b", none)})
    want = F.sequence(F.lit(1), F.greatest(F.array_max("a"), F.array_max("b")))
    return j.select("series", F.sort_array(F.array_except(want, "a")).alias("missing_images"), F.sort_array(F.array_except(want, "b")).alias("missing_sidecars")).filter("size(missing_images) + size(missing_sidecars) > 0")


def merge_maps(maps: list[tuple[str, DataFrame]]) -> DataFrame:
    """U7. Per-subject maps in one table."""
    out = None
    for subject, m in maps:
        m = m.withColumn("subject", F.lit(subject))
        out = m if out is None else out.unionByName(m)
    return out


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(x, F.lit(high)))
