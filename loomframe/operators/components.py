"""Component scores and decisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.functions.scalars import clip, log_ratio
from loomframe.operators.frames import cumulative_cap, in_total_order, settled
from loomframe.operators.joins import manual_overrides
from loomframe.operators.stats import outer_sums, wide_maps


def ridge_r2(maps: DataFrame, priors: DataFrame, lam: float = 10.0) -> DataFrame:
    """L20. component_id, r2 of each map on the templates by ridge regression; negative and undefined values are 0.

    Sums over nodes (templates' products, templates' products with maps, maps' sums) come from one join; the K x K system is
    solved on the driver, and R2 has a closed form in these sums.
    """
    import numpy as np
    import pyarrow as pa

    k, wide = wide_maps(priors, "network_id", "fc")
    g = outer_sums(wide, "a", "a")
    inverse = np.linalg.inv(g + lam * np.eye(len(k)))
    m = maps.join(wide, "node_id").select("component_id", "loading", F.posexplode("a").alias("i", "w"))
    q = m.groupBy("component_id", "i").agg(F.sum(F.col("loading") * F.col("w")).alias("q")).groupBy("component_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "q"))), lambda x: x["q"]).alias("q"))
    sums = maps.join(wide.select("node_id"), "node_id", "left_semi").groupBy("component_id").agg(F.sum("loading").alias("s"), F.sum(F.col("loading") ** 2).alias("ss"), F.count(F.lit(1)).cast("double").alias("n"))

    def fit(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                s, ss, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3, 4))
                beta = x @ inverse.T
                with np.errstate(divide="ignore", invalid="ignore"):
                    r2 = 1 - (ss - 2 * (beta * x).sum(1) + np.einsum("ri,ij,rj->r", beta, g, beta)) / (ss - s**2 / n)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.maximum(np.where(np.isfinite(r2), r2, 0.0), 0.0))], ["component_id", "r2"])

    return q.join(sums, "component_id").select("component_id", "q", "s", "ss", "n").mapInArrow(fit, f"component_id {dict(maps.dtypes)['component_id']}, r2 double")


def template_rho(maps: DataFrame, priors: DataFrame) -> DataFrame:
    """L21. component_id, rho: the largest absolute correlation with a template."""
    c = maps.join(priors, "node_id").groupBy("component_id", "network_id").agg(F.corr("loading", "fc").alias("r"))
    return c.groupBy("component_id").agg(F.coalesce(F.max(F.abs("r")), F.lit(0.0)).alias("rho"))


#: Of doubles; the floor of ratios in decisions.
EPS = 2.220446049250313e-16


def steady_moments(rows: DataFrame, names: list[str]) -> DataFrame:
    """m_<name>, s_<name>: mean and population sd of each column, the same to the last digit in whatever order and partitions rows are. Values less the smallest one, over the
    range, and squared deviations, over the largest, are added up as decimals of 18 places. A column with values that aren't finite has its plain mean and sd."""
    total = lambda x: F.sum(x.try_cast("decimal(28,18)")).cast("double")
    ends = rows.agg(*[f(n).alias(f"{k}_{n}") for n in names for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count), ("pm", F.avg), ("ps", F.stddev_pop))])
    at = lambda k, n: F.col(f"{k}_{n}")
    wide = lambda n: at("hi", n) - at("lo", n)
    plain = lambda n: F.isnan(wide(n)) | (F.abs(wide(n)) == float("inf"))
    ends = rows.sparkSession.createDataFrame(ends.collect(), ends.schema)
    of = lambda w: F.when(w > 0, w).otherwise(1.0)
    parts = rows.crossJoin(F.broadcast(ends)).agg(*[total((F.col(n) - at("lo", n)) / of(wide(n))).alias(f"t_{n}") for n in names])
    means = ends.crossJoin(parts).withColumns({f"m_{n}": F.when(plain(n), at("pm", n)).otherwise(at("lo", n) + wide(n) * (at("t", n) / at("n", n))) for n in names})
    means = means.withColumns({f"w_{n}": of(F.greatest(at("hi", n) - at("m", n), at("m", n) - at("lo", n))) for n in names})
    means = rows.sparkSession.createDataFrame(means.collect(), means.schema)
    over = lambda n: (F.col(n) - at("m", n)) / at("w", n)
    squares = rows.crossJoin(F.broadcast(means)).agg(*[total(over(n) * over(n)).alias(f"q_{n}") for n in names])
    sd = lambda n: F.when(plain(n), at("ps", n)).otherwise(at("w", n) * F.sqrt(at("q", n) / at("n", n)))
    return means.crossJoin(squares).select(*[at("m", n) for n in names], *[sd(n).alias(f"s_{n}") for n in names])


def kill_priority(components: DataFrame, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), eps: float = 1e-8) -> DataFrame:
    """components with priority: weighted z-scores (population sd; without spread 0) of -log ratio, -score and +variance. components are stored once."""
    c = settled(components.withColumn("_lr", log_ratio(F.col("kappa"), F.col("rho"), eps)))
    names = [("_lr", -weights[0]), ("r2", -weights[1]), ("variance_explained", weights[2])]
    s = steady_moments(c, [n for n, _ in names])
    z = sum((w * (F.col(n) - F.col(f"m_{n}")) / F.when(F.col(f"s_{n}") > 0, F.col(f"s_{n}")).otherwise(1.0) for n, w in names), F.lit(0.0))
    return c.crossJoin(F.broadcast(s)).withColumn("priority", z).select(*components.columns, "priority")


def rank_kill_candidates(components: DataFrame, weights: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """T4. priority: weighted z-scores of -log ratio, -score and +variance, and position by falling priority, to nine digits; the smaller id on ties."""
    out = kill_priority(components, weights).withColumn("_by", F.round("priority", 9))
    return in_total_order(out, [F.desc("_by"), F.asc("component_id")]).withColumnRenamed("_position", "position").select(*components.columns, "priority", "position")


@dataclass(frozen=True)
class KillPriority:
    """Of kill candidates, those with at least the var_floor quantile of the candidates' variance go, by falling priority, until cap of their variance is reached."""

    weights: tuple[float, float, float] = (0.50, 0.30, 0.20)
    var_floor: float = 0.60
    cap: float = 0.95


def _finite(c: Column) -> Column:
    """Whether a value is neither null, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def refine_components(
    components: DataFrame, rescue: float = 0.20, rescue_quantile: float = 0.10, kill: float | None = None, adaptive: tuple[float, float, float, float] = (0.10, 0.50, 0.02, 0.10),
    guardrail: bool = True, ratio_most: float = 5.0, priority: KillPriority | None = KillPriority(), accept: DataFrame | None = None, reject: DataFrame | None = None,
) -> DataFrame:
    """L22. Components (component_id, kappa, rho, r2 the score, ratio, variance_explained, keep) with keep decided anew, and initial, rescued, killed, kill_candidate.

    initial is keep, with the guardrail only where kappa > rho. Rescue: not initial, and the score reaches both ``rescue`` and the quantile of
    the initial ones' finite scores (infinite, if there are none); with the guardrail kappa > rho too. Candidates: initial, and the score is under ``kill``, or if that
    is None under the adaptive limit clip(a - b * log ratio, lo, hi); not where kappa > rho and the finite subcortical ratio reaches ratio_most. All candidates are killed, or
    with a priority those that it selects; ties go to the smaller id. Last the guardrail again, then manual ids, rejection winning.

    A component whose score isn't finite is neither rescued nor a candidate. Comparisons with NaN or null are false; a variance that isn't finite counts as 0,
    a null keep as false.
    """
    a, b, lo, hi = adaptive
    kappa, rho, score, ratio = (F.col(n).cast("double") for n in ("kappa", "rho", "r2", "ratio"))
    ahead = _sure((kappa > rho) & ~F.isnan(kappa) & ~F.isnan(rho))
    initial = _sure(F.col("keep")) & (ahead if guardrail else F.lit(True))
    c = components.withColumns({"initial": initial, "_ahead": ahead, "_fin": _finite(score)})
    quantile = F.expr(f"percentile(CASE WHEN initial AND _fin THEN CAST(r2 AS double) END, {rescue_quantile})")
    c = c.crossJoin(F.broadcast(c.agg(F.coalesce(quantile, F.lit(float("inf"))).alias("_q"))))
    rescued = F.col("_fin") & ~F.col("initial") & (score >= rescue) & (score >= F.col("_q")) & (F.col("_ahead") if guardrail else F.lit(True))
    level = F.lit(a) - b * log_ratio(kappa, rho, EPS)
    limit = F.lit(kill) if kill is not None else F.when(level.isNotNull() & ~F.isnan(level), clip(level, lo, hi))
    guarded = _sure(_finite(ratio) & F.col("_ahead") & (ratio >= ratio_most))
    c = c.withColumns({"rescued": _sure(rescued), "kill_candidate": _sure(F.col("_fin") & F.col("initial") & (score < limit)) & ~guarded})
    if priority is None:
        c = c.withColumn("killed", F.col("kill_candidate"))
    else:
        variance = F.when(_finite(F.col("variance_explained").cast("double")), F.col("variance_explained").cast("double")).otherwise(0.0)
        pool = c.filter("kill_candidate").select("component_id", kappa.alias("kappa"), rho.alias("rho"), score.alias("r2"), variance.alias("variance_explained"))
        floor = pool.agg(F.expr(f"percentile(variance_explained, {priority.var_floor})").alias("_f"))
        pool = pool.crossJoin(F.broadcast(floor)).filter(F.col("variance_explained") >= F.col("_f")).drop("_f")
        chosen = cumulative_cap(kill_priority(pool, priority.weights, EPS), "variance_explained", "priority", "component_id", priority.cap)
        c = c.join(chosen.filter("kept").select("component_id", F.lit(True).alias("killed")), "component_id", "left").withColumn("killed", _sure(F.col("killed")))
    final = (F.col("initial") | F.col("rescued")) & ~F.col("killed") & (F.col("_ahead") if guardrail else F.lit(True))
    c = c.withColumn("keep", final).select(*components.columns, *[n for n in ("initial", "rescued", "killed", "kill_candidate") if n not in components.columns])
    if accept is not None or reject is not None:
        none = components.select("component_id").limit(0)
        c = manual_overrides(c, accept if accept is not None else none, reject if reject is not None else none)
    return c


def refine_by_template(components: DataFrame, rescue: float = 0.30, reject: float = 0.10, col: str = "rho") -> DataFrame:
    """L23. Kept above rescue, dropped below reject, unchanged between."""
    return components.withColumn("keep", F.when(F.col(col) > rescue, True).when(F.col(col) < reject, False).otherwise(F.col("keep")))


def decision_summary(components: DataFrame) -> DataFrame:
    """A9. Counts of what refine_components has decided; initial is the decision before."""
    i, k = F.col("initial"), F.col("keep")
    return components.agg(
        F.count_if(i).alias("initial_accept"), F.count_if(~i).alias("initial_reject"), F.count_if("rescued").alias("rescued"), F.count_if("killed").alias("killed"),
        F.count_if("kill_candidate").alias("candidates"), F.count_if(i != k).alias("changed"), F.count_if(k).alias("final_accept"),
    )


