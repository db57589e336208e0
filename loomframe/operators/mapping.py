"""Network mapping: ridge regression of connectivity on network priors, with the fit's quality."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.blocks import MOST, edge_sums, near_sums
from loomframe.operators.dual import block_sums, map_blocks
from loomframe.operators.stats import wide_maps


def zscores(y: np.ndarray) -> np.ndarray:
    """Rows without their means, over their population sd; rows without variance stay 0."""
    sd = y.std(1, keepdims=True)
    return (y - y.mean(1, keepdims=True)) / np.where(sd > 1e-8, sd, 1)


def ridge_fusion(
    vectors: DataFrame, priors: DataFrame, near: DataFrame | tuple[DataFrame, float] | None = None, lam: float = 10.0, fc_weight: float = 1.0, spatial_weight: float = 1.0,
) -> DataFrame:
    """L25, J9. node_id, network_id, beta, p, r2: connectivity of each target with the sources (the nodes that have priors), K betas by ridge regression on the
    networks' maps (centred, of unit length), z-scored over the networks, plus weighted log spatial priors, softmax; r2 of the fit, node by node.

    near: pairs (src target, dst source), or (nodes with coordinates, mm), whose connectivity counts as 0; for targets that are sources only.

    With X the sources' z-scores and y the target's, m = X y / (t - 1). A'm = (A'X) y, the sum of m = (1'X) y and m'm = y'(X'X)y need sums over sources of
    (K + frames) squared numbers; the near pairs' part of each is taken out by block products. The n x n matrix never exists, and r2 = 1 - (m'm - 2 b'A'm + b'A'A b) /
    (m'm - (1'm)^2 / n + 1e-8), which is that of the direct form.
    """
    nets, wide = wide_maps(priors, "network_id", "fc")
    k = len(nets)
    z = map_blocks(vectors.select("node_id", F.col("ts").cast("array<double>").alias("ts")), ["ts"], zscores, "z")
    sources = wide.join(z, "node_id")
    n, total, square = block_sums(sources, ["a"], lambda a: np.vstack([np.full((1, k), len(a)), a.sum(0), (a * a).sum(0)]))
    mean = total / n
    length = np.maximum(np.sqrt(np.maximum(square - n * mean * mean, 0)), 1e-8)
    sources = map_blocks(sources, ["a"], lambda a: (a - mean) / length, "a")
    sums = block_sums(sources, ["a", "z"], lambda a, v: (m := np.hstack([a, np.ones((len(a), 1)), v])).T @ m)
    gram, ax, ones, xx = sums[:k, :k], sums[:k, k + 1 :], sums[k, k + 1 :], sums[k + 1 :, k + 1 :]
    nodes, t = sums[k, k], len(xx)
    inverse, scale = np.linalg.inv(gram + lam * np.eye(k)), 1 / max(t - 1, 1)

    def fit(y: np.ndarray, cut: np.ndarray) -> np.ndarray:
        am = y @ ax.T * scale - cut[:, :k]
        one = y @ ones * scale - cut[:, k]
        mm = ((y @ xx) * y).sum(1) * scale**2 - cut[:, k + 1]
        beta = am @ inverse.T
        rest = mm - 2 * (beta * am).sum(1) + ((beta @ gram) * beta).sum(1)
        return np.column_stack([beta, 1 - rest / (mm - one**2 / nodes + 1e-8)])

    if near is None:
        targets = z.withColumn("s", F.array_repeat(F.lit(0.0), k + 2))
    else:
        sv = sources.select("node_id", F.concat("z", "a").alias("v"))
        tv = sources.select("node_id", F.col("z").alias("v"))

        def block(dist: np.ndarray, y: np.ndarray, v: np.ndarray) -> np.ndarray:
            m = np.where(np.isfinite(dist), y @ v[:, :t].T * scale, 0.0)
            return np.column_stack([m @ v[:, t:], m.sum(1), (m * m).sum(1)])

        def edge(y: np.ndarray, v: np.ndarray) -> np.ndarray:
            m = (y * v[:, :t]).sum(1, keepdims=True) * scale
            return np.hstack([m * v[:, t:], m, m * m])

        if isinstance(near, DataFrame):
            cut = edge_sums(near, tv, sv, edge)
        else:
            places = near[0].select("node_id", *"xyz")
            cut = near_sums(tv.join(places, "node_id"), sv.join(places, "node_id"), near[1], block, most=4 * MOST)
        targets = z.join(cut, "node_id", "left").withColumn("s", F.coalesce("s", F.array_repeat(F.lit(0.0), k + 2)))
    fitted = map_blocks(targets.select("node_id", "z", "s"), ["z", "s"], fit, "b")
    long = fitted.select("node_id", F.col("b")[k].alias("r2"), F.posexplode(F.slice("b", 1, k)).alias("i", "beta"))
    long = long.select("node_id", F.element_at(F.array(*[F.lit(x) for x in nets]), F.col("i") + 1).alias("network_id"), "beta", "r2")
    w = Window.partitionBy("node_id")
    z_beta = (F.col("beta") - F.avg("beta").over(w)) / F.greatest(F.stddev_pop("beta").over(w), F.lit(1e-8))
    score = fc_weight * z_beta + spatial_weight * F.log(F.greatest("spatial", F.lit(1e-6)))
    scored = long.join(priors.select("node_id", "network_id", "spatial"), ["node_id", "network_id"], "left").na.fill({"spatial": 0.5}).withColumn("score", score)
    e = scored.withColumn("_e", F.exp(F.col("score") - F.max("score").over(w)))
    return e.select("node_id", "network_id", "beta", (F.col("_e") / F.greatest(F.sum("_e").over(w), F.lit(1e-8))).alias("p"), "r2")
