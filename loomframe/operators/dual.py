"""Weighted dual regressions chained over several map sets, and exclusive regression. Sums over nodes are partial matrices; node maps never reach the driver."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.operators.blocks import gaussian_smooth
from loomframe.operators.frames import in_total_order, settled
from loomframe.operators.stats import scalar, wide_maps

#: Smallest sample sd that a series or map is divided by.
SD_FLOOR = 1e-5


def block_sums(rows: DataFrame, columns: list[str], f) -> np.ndarray:
    """Sums over rows of the matrix f(blocks of the array or number columns): each partition adds up one matrix, the driver gets one number for each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = f(*[arrow_matrix(c, batch.num_rows) for c in batch.columns])
                total = found if total is None else total + found
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel().astype(float))], ["i", "j", "g"])

    cells = rows.select(*columns).mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()
    if not len(cells):
        raise ValueError("there are no nodes")
    out = np.zeros((cells["i"].max() + 1, cells["j"].max() + 1))
    out[cells["i"], cells["j"]] = cells["g"]
    return out


def arrow_matrix(column: pa.Array, rows: int) -> np.ndarray:
    """A column of lists of doubles of one length, or of doubles, as rows x length."""
    flat = column.flatten() if pa.types.is_list(column.type) else column
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1).astype(float)


def map_blocks(rows: DataFrame, columns: list[str], f, out: str) -> DataFrame:
    """rows without the columns, with out (array<double>): a row of the matrix f(blocks of the columns) for each row."""
    rest = [c for c in rows.columns if c not in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = f(*[arrow_matrix(c, batch.num_rows) for c in batch.columns[len(rest) :]])
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(list(made), pa.list_(pa.float64()))], [*rest, out])

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*rest).schema] + [f"{out} array<double>"])
    return rows.select(*rest, *columns).mapInArrow(run, schema)


def _centred(y: np.ndarray) -> np.ndarray:
    return y - y.mean(1, keepdims=True)


def _scaled(series: np.ndarray) -> np.ndarray:
    """Series (frames x maps) without their means, over their floored sample sd."""
    series = series - series.mean(0)
    return series / np.maximum(series.std(0, ddof=1), SD_FLOOR)


def _weighted_series(rows: DataFrame, maps: list[str], weight: str) -> list[np.ndarray]:
    """For each map column the series (frames x maps) of the weighted spatial regression of every frame on its maps, in one pass.

    Maps and data are multiplied by the root of the weight and then centred over nodes, so the sums are those of the products and of the products with 1.
    """

    def sums(w: np.ndarray, ts: np.ndarray, *m: np.ndarray) -> np.ndarray:
        root = np.sqrt(w)
        left = np.hstack([*[root * x for x in m], np.ones_like(w)])
        return left.T @ np.hstack([left[:, :-1], root * ts, np.ones_like(w)])

    total = block_sums(rows, [weight, "ts", *maps], sums)
    k = len(total) - 1
    n = total[-1, -1]
    centred = total[:k, :-1] - np.outer(total[:k, -1], total[-1, :-1]) / n
    sizes = rows.select(*[F.size(m).alias(m) for m in maps]).first()
    out, at = [], 0
    for m in maps:
        inside = slice(at, at + sizes[m])
        out.append((np.linalg.pinv(centred[inside, inside], hermitian=True) @ centred[inside, k:]).T)
        at += sizes[m]
    return [s - s.mean(0) for s in out]


@dataclass(frozen=True)
class DualRegression:
    """maps: node_id, b (array<double>, in the order of components). series: frames x components, without means, before scaling."""

    maps: DataFrame
    series: np.ndarray


def _second_stage(rows: DataFrame, series: list[np.ndarray], outs: list[str]) -> DataFrame:
    """rows with one map column for each series: the centred data of a node regressed on the scaled series."""
    inverse = np.hstack([np.linalg.pinv(_scaled(s)).T for s in series])
    held = map_blocks(rows.withColumn("_ts", F.col("ts")), ["_ts"], lambda y: _centred(y) @ inverse, "_b")
    ends = np.cumsum([0, *[s.shape[1] for s in series]]).tolist()
    return held.withColumns({o: F.slice("_b", a + 1, b - a) for o, a, b in zip(outs, ends, ends[1:])}).drop("_b")


def weighted_dual_regression(vectors: DataFrame, maps: DataFrame, weights: DataFrame | None = None) -> DualRegression:
    """Stage 1: each frame on the maps (node_id, a) over nodes weighted by w (node_id, w; 1 without); stage 2: each node on the scaled series."""
    rows = vectors.select("node_id", "ts").join(maps.select("node_id", "a"), "node_id")
    rows = rows.withColumn("w", F.lit(1.0)) if weights is None else rows.join(weights.select("node_id", "w"), "node_id")
    [series] = _weighted_series(rows, ["a"], "w")
    return DualRegression(_second_stage(rows, [series], ["b"]).select("node_id", "b"), series)


def alignment_quality(vectors: DataFrame, low_dims: list[DataFrame], nodes: DataFrame, mm: float, sigma: float, areas: DataFrame | None = None) -> DataFrame:
    """node_id, w: how well a subject's own maps agree with each of the group's map sets (node_id, a), node by node.

    For each set: dual regression from the set, and again from what it gives; the correlation of a node's values with the set's, over the set's
    components, as atanh. The mean over sets, minus its Gaussian smoothing over nodes within mm, plus its mean; positive parts cubed, others 0.
    A node without variance in a set counts as 0 there; correlations are kept within 1 - 1e-6.
    """
    names = [f"a{i}" for i in range(len(low_dims))]
    rows = vectors.select("node_id", "ts")
    for n, maps in zip(names, low_dims):
        rows = rows.join(maps.select("node_id", F.col("a").alias(n)), "node_id")
    rows = rows.withColumn("area", F.lit(1.0)) if areas is None else rows.join(areas.select("node_id", F.col("w").alias("area")), "node_id")
    once = [f"b{i}" for i in range(len(low_dims))]
    first = _second_stage(rows, _weighted_series(rows, names, "area"), once)
    second = _weighted_series(first, once, "area")
    inverse = [np.linalg.pinv(_scaled(s)).T for s in second]

    def agreement(ts: np.ndarray, *maps: np.ndarray) -> np.ndarray:
        y, found = _centred(ts), []
        for m, inv in zip(maps, inverse):
            a, b = _centred(m), _centred(y @ inv)
            size = np.sqrt((a * a).sum(1) * (b * b).sum(1))
            r = np.divide((a * b).sum(1), size, out=np.zeros(len(a)), where=size > 0)
            found.append(np.arctanh(np.clip(r, -1 + 1e-6, 1 - 1e-6)))
        return np.mean(found, 0)[:, None]

    q = settled(map_blocks(rows.select("node_id", "ts", *names), ["ts", *names], agreement, "q").select("node_id", F.col("q")[0].alias("value")))
    smooth = gaussian_smooth(q, nodes, mm, sigma).withColumnRenamed("value", "_s")
    level = q.join(smooth, "node_id").crossJoin(scalar(q, F.avg("value").alias("_m")))
    return level.select("node_id", F.pow(F.greatest(F.lit(0.0), F.col("_m") + F.col("value") - F.col("_s")), F.lit(3)).alias("w"))


def reweighted_dual_regression(vectors: DataFrame, low_dims: list[DataFrame], group: DataFrame, nodes: DataFrame, mm: float, sigma: float, areas: DataFrame | None = None) -> tuple[DualRegression, DataFrame]:
    """L14. The group's maps (node_id, a) on a subject's vectors: weighted by area and alignment quality first, then from the maps that this gives,
    each centred and scaled over nodes, by area alone. Returns that regression and the alignment weights (node_id, w).

    Over nodes, all that is formed are sums of components x (components + frames) in each partition; every step is one pass over the nodes.
    """
    weights = settled(alignment_quality(vectors, low_dims, nodes, mm, sigma, areas))
    rows = vectors.select("node_id", "ts").join(group.select("node_id", "a"), "node_id").join(weights.select("node_id", F.col("w").alias("q")), "node_id")
    rows = rows.withColumn("area", F.lit(1.0)) if areas is None else rows.join(areas.select("node_id", F.col("w").alias("area")), "node_id")
    rows = rows.withColumn("wq", F.col("area") * F.col("q"))
    own = _second_stage(rows, _weighted_series(rows, ["a"], "wq"), ["b"])
    moments = block_sums(own, ["b"], lambda b: np.vstack([np.full((1, b.shape[1]), len(b)), b.sum(0), (b * b).sum(0)]))
    n, mean = moments[0], moments[1] / moments[0]
    sd = np.maximum(np.sqrt(np.maximum(moments[2] - n * mean * mean, 0) / np.maximum(n - 1, 1)), SD_FLOOR)
    scaled = map_blocks(own.select("node_id", "ts", "area", "b"), ["b"], lambda b: (b - mean) / sd, "m")
    [series] = _weighted_series(scaled, ["m"], "area")
    return DualRegression(_second_stage(scaled, [series], ["c"]).select("node_id", F.col("c").alias("b")), series), weights


def _leading(start: np.ndarray, times, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors: components x frames) of the leading pairs of K symmetric matrices that only ``times`` knows: for blocks of
    vectors (K x frames x q) it returns the matrices times them. Block Lanczos with the whole basis kept: done when the residuals are nothing, at the latest
    when the basis is complete."""
    k, t, q = start.shape
    basis = [np.linalg.qr(s)[0] for s in start]
    images = [b[:, :0] for b in basis]
    fresh = np.stack(basis)
    values, vectors = np.zeros(k), np.zeros((k, t))
    for _ in range(rounds):
        got, done, following = times(fresh), True, []
        for i in range(k):
            images[i] = np.hstack([images[i], got[i]])[:, : basis[i].shape[1]]
            small = basis[i].T @ images[i]
            e, u = np.linalg.eigh((small + small.T) / 2)
            values[i], vectors[i] = max(e[-1], 0.0), basis[i] @ u[:, -1]
            rest = np.linalg.norm(images[i] @ u[:, -1] - e[-1] * vectors[i])
            room = t - basis[i].shape[1]
            if rest > 1e-12 * max(abs(e[-1]), 1e-300) and room > 0:
                done = False
            block = got[i] / max(np.linalg.norm(got[i]), 1e-300)
            block -= basis[i] @ (basis[i].T @ block)
            block -= basis[i] @ (basis[i].T @ block)
            # directions that are in the basis already are replaced by any others
            filled = np.hstack([block, np.eye(t)[:, np.argsort(np.abs(basis[i]).sum(1))[: q]]])
            filled -= basis[i] @ (basis[i].T @ filled)
            new, r = np.linalg.qr(filled)
            strong = [c for c in range(r.shape[0]) if abs(r[c, c]) > 1e-10][: min(q, room)]
            new = new[:, strong] - basis[i] @ (basis[i].T @ new[:, strong])
            new = np.linalg.qr(new)[0] if new.shape[1] else new
            basis[i] = np.hstack([basis[i], new])
            following.append(np.pad(new, ((0, 0), (0, q - new.shape[1]))))
        if done:
            break
        fresh = np.stack(following)
    return np.sqrt(values), vectors


def exclusive_regression(maps: DataFrame, vectors: DataFrame, above: float = 0.5, block: int = 4) -> DataFrame:
    """L34. component_id, frame, value: for each component the other maps are regressed out of its map and of the data (node_id, ts); of what is left of the
    map times what is left of the data, both over the data's temporal sd, the leading temporal component, scaled by the median positive weight.

    With R the data without all maps, u what is left of map j and c its coefficients, the data without the other maps are R + u c: one residual and K
    rank-one terms stand for K deflated matrices. Their leading pairs come from products with blocks of vectors, one pass over the nodes each, in which a
    partition adds up K x frames x block numbers; neither the matrices nor their frames x frames products exist.

    The median is over nodes whose map exceeds ``above``; the sign is that of the component's mean there. A component without such nodes has null values.
    """
    ids, wide = wide_maps(maps, "component_id", "loading")
    k = len(ids)
    rows = settled(vectors.select("node_id", F.col("ts").cast("array<double>").alias("ts")).join(wide, "node_id"))

    def sums(a: np.ndarray, ts: np.ndarray) -> np.ndarray:
        left = np.hstack([a, np.ones((len(a), 1))])
        return left.T @ np.hstack([left, _centred(ts)])

    total = block_sums(rows, ["a", "ts"], sums)
    n, mean = total[k, k], total[:k, k] / total[k, k]
    frame_mean = total[k, k + 1 :] / n
    gram = total[:k, :k] - n * np.outer(mean, mean)
    cross = total[:k, k + 1 :] - n * np.outer(mean, frame_mean)
    joint = np.linalg.pinv(gram, hermitian=True) @ cross
    # left over of map j beside all others: the maps times column j; nothing, where the others span it
    beside, size = np.eye(k), np.zeros(k)
    for j in range(k):
        others = [i for i in range(k) if i != j]
        part = np.linalg.pinv(gram[np.ix_(others, others)], hermitian=True) @ gram[others, j] if others else np.zeros(0)
        beside[others, j] = -part
        size[j] = gram[j, j] - part @ gram[others, j]
    alone = size > 1e-10 * np.maximum(np.diag(gram), 1e-300)
    own = np.where(alone[:, None], (beside.T @ cross) / np.where(alone, size, 1)[:, None], 0.0)
    t = cross.shape[1]
    energy = (own * own).sum(1)

    def parts(a: np.ndarray, ts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(residual, what is left of the maps with their means, what is left without, temporal sd) of a block of nodes."""
        centred = a - mean
        rest = _centred(ts) - frame_mean - centred @ joint
        u = np.where(alone, centred @ beside, 0.0)
        sd = np.sqrt(np.maximum((rest * rest).sum(1, keepdims=True) + 2 * u * (rest @ own.T) + u * u * energy, 0) / (t - 1))
        return rest, centred @ beside + mean, u, np.maximum(sd, np.finfo(float).eps)

    def times(v: np.ndarray) -> np.ndarray:
        def run(a: np.ndarray, ts: np.ndarray) -> np.ndarray:
            rest, left, u, sd = parts(a, ts)
            out = []
            for j in range(k):
                weight = ((left[:, j] / sd[:, j]) ** 2)[:, None]
                image = weight * (rest @ v[j] + np.outer(u[:, j], own[j] @ v[j]))
                out.append(rest.T @ image + np.outer(own[j], u[:, j] @ image))
            return np.vstack(out)

        return block_sums(rows, ["a", "ts"], run).reshape(k, t, -1)

    start = np.random.default_rng(0).normal(size=(k, t, min(block, t)))
    values, series = _leading(start, times, rounds=-(-t // min(block, t)) + 2)

    def weights(a: np.ndarray, ts: np.ndarray) -> np.ndarray:
        rest, left, u, sd = parts(a, ts)
        uu = np.stack([left[:, j] / sd[:, j] * (rest @ series[j] + u[:, j] * (own[j] @ series[j])) / max(values[j], 1e-300) for j in range(k)], 1)
        return np.hstack([np.where(left > above, uu, np.nan), np.where(left > above, np.abs(uu) * sd, np.nan)])

    held = map_blocks(rows.select("node_id", "a", "ts"), ["a", "ts"], weights, "w").select("node_id", F.posexplode(F.transform(F.slice("w", 1, k), lambda x, i: F.struct(x.alias("u"), F.col("w")[i + k].alias("s")))).alias("j", "p"))
    high = settled(held.select("j", "node_id", "p.u", "p.s").filter("NOT isnan(u)"))
    stats = {r["j"]: r for r in high.groupBy("j").agg(F.avg("u").alias("u"), F.count(F.lit(1)).alias("n")).collect()}
    placed = in_total_order(high, [F.asc("j"), F.asc("s"), F.asc("node_id")])
    wanted, before = [], 0
    for j in sorted(stats):
        wanted += [(before + p, j) for p in {(stats[j]["n"] + 1) // 2, stats[j]["n"] // 2 + 1}]
        before += stats[j]["n"]
    middle = placed.join(F.broadcast(maps.sparkSession.createDataFrame(wanted, "_position int, _j int")), "_position").groupBy("j").agg(F.avg("s").alias("m")) if wanted else None
    medians = {r["j"]: r["m"] for r in middle.collect()} if middle is not None else {}
    scale = [np.sign(stats[j]["u"]) * medians[j] * values[j] if j in stats else np.nan for j in range(k)]
    series = series - series.mean(1, keepdims=True)
    out = [(c, i, None if np.isnan(scale[j]) else float(scale[j] * series[j, i])) for j, c in enumerate(ids) for i in range(t)]
    return maps.sparkSession.createDataFrame(out, f"component_id {dict(maps.dtypes)['component_id']}, frame int, value double")
