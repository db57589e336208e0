"""Regressions of many runs in one plan: each run's small matrix is a row of a table and meets blocks of the run's nodes.

Vectors are run, node_id, ts (array<double>, as long as the run has frames). A matrix (frames x columns) of a run is one row: run, its columns' number and its
values, row by row; ``packed`` makes such rows from a long table. Nothing of a run reaches the driver. Runs with more than MOST nodes are cut into
blocks by node, and the matrix goes once to each. A run with vectors but without its matrix is an error; a matrix without vectors gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.blocks import _pieces, _stack
from loomframe.operators.linear import highpass_matrix

#: Cells of the partial Gram matrices that a partition holds before it gives them out.
HELD = 1 << 24


def run_vectors(signal: DataFrame, missing: float = 0.0) -> DataFrame:
    """run, node_id, ts of a long signal (run, node_id, frame, value): one entry for each frame from the run's first to its last; cells that are missing get that
    value. A run's frames are counted from 0."""
    ends = signal.groupBy("run").agg(F.min("frame").alias("_lo"), F.max("frame").alias("_hi"))
    cells = signal.filter(F.col("value").isNotNull()).groupBy("run", "node_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("frame").cast("int"), F.col("value").cast("double")))).alias("_m"))
    frames = F.sequence(F.col("_lo").cast("int"), F.col("_hi").cast("int"))
    return cells.join(F.broadcast(ends), "run").select("run", "node_id", F.transform(frames, lambda f: F.coalesce(F.element_at("_m", f), F.lit(missing))).alias("ts"))


def packed(columns: DataFrame, name: str) -> DataFrame:
    """run, {name}_cols, {name}: the matrix of each run from its long form (run, frame, column, value), frames and columns in order."""
    wide = columns.groupBy("run", "frame").agg(F.transform(F.array_sort(F.collect_list(F.struct("column", F.col("value").cast("double").alias("v")))), lambda x: x["v"]).alias("_r"))
    rows = wide.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("frame", "_r"))).alias("_m"))
    return rows.select("run", F.size(F.col("_m")[0]["_r"]).alias(f"{name}_cols"), F.flatten(F.transform("_m", lambda x: x["_r"])).alias(name))


def unpacked(matrices: DataFrame, name: str) -> DataFrame:
    """run, frame, column, value of a packed matrix, from 0."""
    cell = matrices.select("run", F.col(f"{name}_cols").alias("_c"), F.posexplode(name).alias("_i", "value"))
    return cell.select("run", F.floor(F.col("_i") / F.col("_c")).cast("int").alias("frame"), (F.col("_i") % F.col("_c")).cast("int").alias("column"), "value")


def matrix_of(row: pd.Series, name: str) -> np.ndarray:
    """The packed matrix of a row; of no columns, if there is none."""
    cols = int(row[f"{name}_cols"])
    return np.asarray(row[name], float).reshape(-1, cols) if cols else np.zeros((0, 0))


def with_matrices(vectors: DataFrame, matrices: DataFrame, f: Callable[[np.ndarray, pd.Series], np.ndarray], out: str) -> DataFrame:
    """run, node_id, out: f(block of a run's vectors, the run's row of matrices), a row of numbers for each node."""
    sizes, some = _pieces(vectors.select("run"), ["run"], "p")

    def sized(rows: DataFrame) -> DataFrame:
        return rows.join(sizes, "run", "left").withColumn("p", F.coalesce("p", F.lit(1))) if some else rows.withColumn("p", F.lit(1))

    left = sized(vectors.select("run", "node_id", "ts")).withColumn("p", F.pmod(F.xxhash64("node_id"), F.col("p")).cast("int"))
    right = sized(matrices).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
    right = right.select(*[F.col(c).alias(f"_{c}") if c in ("run", "p") else c for c in right.columns])

    def apply(nodes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes):
            return pd.DataFrame({"run": [], "node_id": [], out: []}, dtype=object)
        if len(rows) != 1:
            raise ValueError(f"run {nodes['run'].iloc[0]} has {len(rows)} matrices")
        made = f(_stack(nodes["ts"]), rows.iloc[0])
        return pd.DataFrame({"run": nodes["run"], "node_id": nodes["node_id"], out: pd.Series(list(made), index=nodes.index, dtype=object)})

    kinds = dict(vectors.dtypes)
    return left.groupBy("run", "p").cogroup(right.groupBy("_run", "_p")).applyInPandas(apply, f"run {kinds['run']}, node_id {kinds['node_id']}, {out} array<double>")


def each_matrix(matrices: DataFrame, f: Callable[[pd.Series], np.ndarray], out: str, more: str = "") -> DataFrame:
    """run, {out}_cols, {out} (and more, which f returns as a second value): f of each run's row, which is a task group of its own."""

    def apply(rows: pd.DataFrame) -> pd.DataFrame:
        made = f(rows.iloc[0])
        m, rest = made if more else (made, None)
        found = {"run": [rows["run"].iloc[0]], f"{out}_cols": [m.shape[1]], out: [m.ravel().tolist()]}
        return pd.DataFrame(found | ({more.split(" ")[0]: [list(map(float, rest))]} if more else {}))

    kind = dict(matrices.dtypes)["run"]
    return matrices.groupBy("run").applyInPandas(apply, f"run {kind}, {out}_cols int, {out} array<double>" + (f", {more}" if more else ""))


def run_grams(vectors: DataFrame) -> DataFrame:
    """run, gram_cols, gram: each run's products of frames, summed over its nodes' series without their means.

    A partition adds up one matrix for each run it meets and gives it out at the end, or when it holds HELD cells; partial sums are added.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def out() -> Iterator[pa.RecordBatch]:
            for key, total in held.items():
                i, j = np.triu_indices(len(total))
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(i), kind), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["run", "i", "j", "g"])
            held.clear()

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            frame = batch.to_pandas()
            for key, group in frame.groupby("run"):
                y = _stack(group["ts"])
                y = y - y.mean(1, keepdims=True)
                held[key] = held.get(key, 0) + y.T @ y
            if sum(m.size for m in held.values()) > HELD:
                yield from out()
        yield from out()

    kind = dict(vectors.dtypes)["run"]
    cells = vectors.select("run", "ts").mapInArrow(run, f"run {kind}, i int, j int, g double").groupBy("run", "i", "j").agg(F.sum("g").alias("value"))
    both = cells.select("run", F.col("i").alias("frame"), F.col("j").alias("column"), "value").unionByName(cells.filter("i < j").select("run", F.col("j").alias("frame"), F.col("i").alias("column"), "value"))
    return packed(both, "gram")


def _kept(s: np.ndarray, cond_max: float) -> int:
    """Leading singular values with s1 / s <= sqrt(cond_max); one at least, none if all are 0."""
    return max(1, int((s[0] <= np.sqrt(cond_max) * np.maximum(s, 1e-12)).sum())) if len(s) and s[0] > 0 else 0


def compartment_components(vectors: DataFrame, mask: DataFrame, cond_max: float = 30.0) -> DataFrame:
    """L3. run, basis_cols, basis, eigenvalues: leading temporal components of each run's masked nodes (run, node_id). A run without masked nodes has no columns."""

    def leading(row: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        values, axes = np.linalg.eigh(matrix_of(row, "gram"))
        values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
        # what the sums' rounding leaves isn't a component
        values = np.where(values > len(values) * np.finfo(float).eps * values[0], values, 0)
        keep = _kept(np.sqrt(values), cond_max)
        return axes[:, :keep], values[:keep]

    found = each_matrix(run_grams(vectors.join(mask.select("run", "node_id").distinct(), ["run", "node_id"], "left_semi")), leading, "basis", "eigenvalues array<double>")
    runs = vectors.select("run").distinct()
    empty = F.array().cast("array<double>")
    return runs.join(found, "run", "left").select("run", F.coalesce("basis_cols", F.lit(0)).alias("basis_cols"), F.coalesce("basis", empty).alias("basis"), F.coalesce("eigenvalues", empty).alias("eigenvalues"))


def _conditioned(x: np.ndarray, cond_max: float) -> np.ndarray:
    sd = x.std(0)
    z = np.nan_to_num((x - x.mean(0)) / np.where(sd > 0, sd, 1), posinf=0.0, neginf=0.0)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    return u[:, : _kept(s, cond_max)]


def condition_designs(designs: DataFrame, cond_max: float = 30.0) -> DataFrame:
    """L4. run, basis_cols, basis: an orthonormal basis of each run's z-scored design columns, without the weak directions."""
    return each_matrix(designs, lambda row: _conditioned(matrix_of(row, "design"), cond_max), "basis")


def nuisance_regression(vectors: DataFrame, designs: DataFrame, keep: DataFrame | None = None, cond_max: float = 30.0) -> DataFrame:
    """L5. run, node_id, ts without the part of the run's conditioned design; fitted with an intercept on kept frames (run, frame, keep; frames without a row are
    kept), subtracted on all. Fewer than two kept frames are an error, as is a design without any direction."""
    rows = condition_designs(designs, cond_max)
    out = keep.filter("NOT keep").groupBy("run").agg(F.collect_list(F.col("frame").cast("int")).alias("dropped")) if keep is not None else None
    rows = rows.join(out, "run", "left") if out is not None else rows.withColumn("dropped", F.lit(None).cast("array<int>"))

    def clean(y: np.ndarray, row: pd.Series) -> np.ndarray:
        basis = matrix_of(row, "basis")
        if not basis.size:
            raise ValueError("the design has no direction left")
        kept = np.ones(len(basis), bool)
        kept[[f for f in (row["dropped"] if row["dropped"] is not None else []) if 0 <= f < len(kept)]] = False
        if kept.sum() < 2:
            raise ValueError("fewer than two frames are kept")
        inverse = np.linalg.pinv(np.column_stack([basis, np.ones(len(basis))])[kept])
        return y - (y[:, kept] @ inverse.T)[:, :-1] @ basis.T

    return with_matrices(vectors, rows, clean, "ts")


def denoise(vectors: DataFrame, compartments: list[DataFrame], ribbon: DataFrame, motion: DataFrame, brain: DataFrame | None = None, keep: DataFrame | None = None, compartment_cond_max: float = 30.0, design_cond_max: float = 250.0) -> DataFrame:
    """L3, L4 and L5 of all runs at once. Each run's design: the components of each compartment (run, node_id), the mean series of the ribbon's nodes, its
    backward difference, and the motion columns (run, frame, column, value). Nodes outside the brain stay as they are."""
    held, parts = motion.select("run", "frame", F.col("column").cast("int").alias("column"), "value"), []
    for k, mask in enumerate(compartments):
        parts.append(unpacked(compartment_components(vectors, mask, compartment_cond_max), "basis").withColumn("column", F.col("column") + 10_000 * (k + 1)))
    inside = vectors.join(ribbon.select("run", "node_id").distinct(), ["run", "node_id"], "left_semi")
    level = inside.select("run", F.posexplode("ts").alias("frame", "v")).groupBy("run", "frame").agg(F.avg("v").alias("value"))
    step = F.col("value") - F.lag("value").over(Window.partitionBy("run").orderBy("frame"))
    parts += [level.select("run", "frame", F.lit(-2).alias("column"), "value"), level.select("run", "frame", F.lit(-1).alias("column"), F.coalesce(step, F.lit(0.0)).alias("value"))]
    for p in parts:
        held = held.unionByName(p)
    clean = vectors if brain is None else vectors.join(brain.select("run", "node_id").distinct(), ["run", "node_id"], "left_semi")
    done = nuisance_regression(clean, packed(held, "design"), keep, design_cond_max)
    return done if brain is None else done.unionByName(vectors.join(brain.select("run", "node_id").distinct(), ["run", "node_id"], "left_anti").select("run", "node_id", "ts"))


def regress_out(vectors: DataFrame, designs: DataFrame) -> DataFrame:
    """L8. run, node_id, ts: Y - X pinv(X) Y with each run's design."""

    def clean(y: np.ndarray, row: pd.Series) -> np.ndarray:
        x = matrix_of(row, "design")
        return y - y @ np.linalg.pinv(x).T @ x.T

    return with_matrices(vectors, designs, clean, "ts")


def _listed(row: pd.Series, name: str) -> list[int]:
    return [int(i) for i in row[name]] if row[name] is not None else []


def remove_components(vectors: DataFrame, mixing: DataFrame, noise: DataFrame) -> DataFrame:
    """L9. run, node_id, ts: all of a run's components (packed as mixing) are fitted, those of noise (run, component_id from 0) are subtracted."""
    rows = mixing.join(noise.groupBy("run").agg(F.collect_list(F.col("component_id").cast("int")).alias("ids")), "run", "left")

    def clean(y: np.ndarray, row: pd.Series) -> np.ndarray:
        m, ids = matrix_of(row, "mixing"), _listed(row, "ids")
        return y - (y @ np.linalg.pinv(m).T)[:, ids] @ m[:, ids].T

    return with_matrices(vectors, rows, clean, "ts")


STAGES = ["original", "filtered", "unmoved", "cleaned", "unstructured", "noise", "signal"]


def variance_decomposition(vectors: DataFrame, mixing: DataFrame, noise: DataFrame, motion: DataFrame, sigma: float) -> DataFrame:
    """L7. run, node_id and sample variances along the stages: original, high-pass (sigma frames), without motion, without noise components, without any
    component; of the noise and of the signal part. mixing and motion are packed matrices."""
    rows = mixing.join(motion, "run").join(noise.groupBy("run").agg(F.collect_list(F.col("component_id").cast("int")).alias("ids")), "run", "left")

    def stages(y: np.ndarray, row: pd.Series) -> np.ndarray:
        m, move, bad = matrix_of(row, "mixing"), matrix_of(row, "motion"), _listed(row, "ids")
        high = highpass_matrix(len(m), sigma)
        good = [k for k in range(m.shape[1]) if k not in bad]
        moved = move @ np.linalg.pinv(move)
        mix = high @ m
        mix = mix - moved @ mix
        filtered = y @ high.T
        unmoved = filtered - filtered @ moved.T
        beta = unmoved @ np.linalg.pinv(mix).T
        noise_, signal_ = beta[:, bad] @ mix[:, bad].T, beta[:, good] @ mix[:, good].T
        return np.column_stack([v.var(1, ddof=1) for v in (y, filtered, unmoved, unmoved - noise_, unmoved - noise_ - signal_, noise_, signal_)])

    return with_matrices(vectors, rows, stages, "v").select("run", "node_id", *[F.col("v")[i].alias(n) for i, n in enumerate(STAGES)])


def component_beta_maps(vectors: DataFrame, mixing: DataFrame) -> DataFrame:
    """L12. run, component_id (from 0), node_id, loading: betas beside an intercept."""

    def betas(y: np.ndarray, row: pd.Series) -> np.ndarray:
        m = matrix_of(row, "mixing")
        return y @ np.linalg.pinv(np.column_stack([m, np.ones(len(m))]))[:-1].T

    return with_matrices(vectors, mixing, betas, "b").select("run", "node_id", F.posexplode("b").alias("component_id", "loading"))
