"""Products of sparse weights with node vectors in blocks: no row for a pair of nodes, and none for a pair and frame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nodes of one side that a task holds at most.
MOST = 4096
#: Blocks with more nodes than MOST whose sizes are broadcast at most; with more of them, sizes are joined by shuffling.
BROADCAST_BLOCKS = 100_000
#: Cells of a matrix that is formed at once.
CELLS = 1 << 18

Product = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _pieces(rows: DataFrame, keys: list[str], out: str, most: int = MOST) -> tuple[DataFrame, bool]:
    """keys, out: the number of pieces of blocks with more than most rows, and whether there are any."""
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    several = large.count()
    table = large.select(*keys, F.ceil(F.col("_n") / most).cast("int").alias(out))
    return (F.broadcast(table) if several <= BROADCAST_BLOCKS else table), several > 0


def _dealt(rows: DataFrame, keys: list[str], node: str, own: tuple[str, DataFrame, bool], other: tuple[str, DataFrame, bool]) -> DataFrame:
    """rows in the piece of their own side that their node's hash names, and once for each piece of the other side."""
    for name, table, some in (own, other):
        rows = rows.join(table, keys, "left").withColumn(name, F.coalesce(name, F.lit(1))) if some else rows.withColumn(name, F.lit(1))
    mine = F.pmod(F.xxhash64(node), F.col(own[0])).cast("int")
    return rows.withColumn(own[0], mine).withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[0]) - 1)))


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, 0))


def _sums_frame(ids: np.ndarray, sums: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"node_id": ids, "s": pd.Series(sums, dtype=object)})


def _summed(parts: DataFrame, several: bool) -> DataFrame:
    """node_id, s: partial sums added up, where a node has several."""
    if not several:
        return parts
    add = F.aggregate(F.slice("l", 2, F.size("l")), F.col("l")[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    return parts.groupBy("node_id").agg(F.collect_list("s").alias("l")).select("node_id", add.alias("s"))


def _near_cubes(targets: DataFrame, sources: DataFrame, mm: float, cells: int, most: int, multiply: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> tuple[DataFrame, bool]:
    """Rows of multiply for each pair of pieces of targets (node_id, tx, ty, tz, tv) and sources (other, sx, sy, sz, sv) that may be within mm, and whether a target
    may be in several of them.

    Nodes are dealt to cubes of cells * mm; a source goes to the cubes that it is within mm of. A cube with more than most nodes on a side is cut into pieces, and
    pairs of pieces are tasks of their own, so neither a task's memory nor the rows between tasks grow with the number of pairs. A node without coordinates is
    near nothing.
    """
    side, reach = cells * mm, mm * (1 + 1e-9)
    box = ["bx", "by", "bz"]
    known = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
    floor = lambda c: F.floor(c / side)
    # the two sides' columns are named apart: they may come from one table
    t = targets.filter(known).select("node_id", *[F.col(c).alias(f"t{c}") for c in "xyzv"], *[floor(F.col(c)).alias(b) for c, b in zip("xyz", box)])
    s = sources.filter(known).select(F.col("node_id").alias("other"), *[F.col(c).alias(f"s{c}") for c in "xyzv"])
    for c, b in zip("xyz", box):
        s = s.withColumn(b, F.explode(F.sequence(floor(F.col(f"s{c}") - reach), floor(F.col(f"s{c}") + reach))))
    tp, sp = ("p", *_pieces(t.select(*box), box, "p", most)), ("q", *_pieces(s.select(*box), box, "q", most))
    left, right = _dealt(t, box, "node_id", tp, sp), _dealt(s, box, "other", sp, tp)
    keys = [*box, "p", "q"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(multiply, schema), sp[2]


def _distances(a: pd.DataFrame, b: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Distances of targets and sources, some targets at a time: the first one's place, targets x sources."""
    return _apart(a[["tx", "ty", "tz"]].to_numpy(float), b[["sx", "sy", "sz"]].to_numpy(float))


def _apart(at: np.ndarray, bt: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    step = max(1, CELLS // max(1, len(bt)))
    for k in range(0, len(at) if len(bt) else 0, step):
        # coordinate by coordinate, so that the rounding is that of the pairs' own formula
        yield k, np.sqrt(sum((at[k : k + step, None, c] - bt[None, :, c]) ** 2 for c in range(3)))


def _close(at: np.ndarray, bt: np.ndarray, mm: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the targets of one small cube (of mm / 2, larger if that has few of them), and of the sources that may be within mm of one of them."""
    known = np.flatnonzero(np.isfinite(at).all(1))
    side, group = mm / 4, np.zeros(len(known), int)
    while len(known):
        side *= 2
        found, group = np.unique(np.floor(at[known] / side), axis=0, return_inverse=True)
        if len(found) * 8 <= len(known) or side >= 2 * mm:
            break
    order = np.argsort(group.ravel(), kind="stable")
    for own in np.split(known[order], np.flatnonzero(np.diff(group.ravel()[order])) + 1):
        if len(own):
            gap = np.maximum(np.maximum(at[own].min(0) - bt, bt - at[own].max(0)), 0)
            others = np.flatnonzero((gap * gap).sum(1) <= (mm * (1 + 1e-9)) ** 2)
            if len(others):
                yield own, others


def near_sums(targets: DataFrame, sources: DataFrame, mm: float, product: Product, cells: int = 4, most: int | None = None) -> DataFrame:
    """node_id, s (array<double>) of targets that have a source within mm (inclusive): product(dist, tv, sv) over all sources near them.

    targets and sources: node_id, x, y, z, v (array<double> of one length on each side). product gets blocks: distances (targets x sources, infinite
    beyond mm) and the two sides' vectors, and returns targets x anything; it must be a sum over sources. Blocks are small cubes of targets with what may be near
    them, so that few of the pairs that are looked at are far. A task holds at most most (MOST) nodes of a side. A node without coordinates is near nothing.
    """

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids, out = [], []
        if len(a) and len(b):
            av, bv, names = _stack(a["tv"]), _stack(b["sv"]), a["node_id"].to_numpy()
            at, bt = a[["tx", "ty", "tz"]].to_numpy(float), b[["sx", "sy", "sz"]].to_numpy(float)
            for own, others in _close(at, bt, mm):
                v = bv[others]
                for k, dist in _apart(at[own], bt[others]):
                    near, rows = dist <= mm, own[k : k + len(dist)]
                    some = near.any(1)
                    if some.any():
                        ids.append(names[rows[some]])
                        out += list(product(np.where(near, dist, np.inf)[some], av[rows[some]], v))
        return _sums_frame(np.concatenate(ids) if ids else np.zeros(0, np.int64), out)

    kind = dict(targets.dtypes)["node_id"]
    parts, several = _near_cubes(targets, sources, mm, cells, most or MOST, multiply, f"node_id {kind}, s array<double>")
    return _summed(parts, several)


#: Nodes of one side of a task that lists pairs.
MOST_LISTED = 1024


def near_list(nodes: DataFrame, targets: DataFrame, mm: float, half: bool = False) -> DataFrame:
    """src (of nodes), dst (of targets), dist within mm (inclusive); half: src < dst only. A task lists at most the pairs of MOST_LISTED nodes a side; they aren't exchanged."""
    of = lambda t: t.select("node_id", *"xyz", F.lit(None).cast("int").alias("v"))

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        parts = []
        src, dst = a["node_id"].to_numpy(), b["other"].to_numpy()
        for k, dist in _distances(a, b):
            i, j = np.nonzero(dist <= mm)
            if half:
                keep = src[k + i] < dst[j]
                i, j = i[keep], j[keep]
            parts.append(pd.DataFrame({"src": src[k + i], "dst": dst[j], "dist": dist[i, j]}))
        return pd.concat(parts) if parts else pd.DataFrame({"src": src[:0], "dst": dst[:0], "dist": np.zeros(0)})

    kinds = dict(nodes.dtypes)["node_id"], dict(targets.dtypes)["node_id"]
    return _near_cubes(of(nodes), of(targets), mm, 1, MOST_LISTED, multiply, f"src {kinds[0]}, dst {kinds[1]}, dist double")[0]


def near_first(targets: DataFrame, sources: DataFrame, mm: float) -> DataFrame:
    """node_id, dist, other, v: the nearest source (node_id, x, y, z, v) within mm of each target that has one, the smaller id on ties."""
    kinds = dict(targets.dtypes)["node_id"], dict(sources.dtypes)["node_id"], dict(sources.dtypes)["v"]

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("other")
        parts = []
        for k, dist in _distances(a, b):
            j = np.where(dist <= mm, dist, np.inf).argmin(1)
            least = dist[np.arange(len(dist)), j]
            some = least <= mm
            parts.append(pd.DataFrame({"node_id": a["node_id"].to_numpy()[k : k + len(dist)][some], "dist": least[some], "other": b["other"].to_numpy()[j[some]], "v": b["sv"].to_numpy()[j[some]]}))
        return pd.concat(parts) if parts else pd.DataFrame({"node_id": [], "dist": [], "other": [], "v": []})

    given = targets.select("node_id", *"xyz", F.lit(None).cast("int").alias("v"))
    parts, _ = _near_cubes(given, sources, mm, 1, MOST, multiply, f"node_id {kinds[0]}, dist double, other {kinds[1]}, v {kinds[2]}")
    best = parts.groupBy("node_id").agg(F.min_by(F.struct("dist", "other", "v"), F.struct("dist", "other")).alias("b"))
    return best.select("node_id", "b.*")


def near_before(targets: DataFrame, sources: DataFrame, mm: float, any_order: bool = False) -> DataFrame:
    """node_id of targets (node_id, x, y, z, v) with another source within mm that comes before them by (v, node_id); any_order: with any source within mm, itself too."""

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        own, h, others, g = a["node_id"].to_numpy(), a["tv"].to_numpy(), b["other"].to_numpy(), b["sv"].to_numpy()
        found = np.zeros(len(a), bool)
        for k, dist in _distances(a, b):
            cut = slice(k, k + len(dist))
            near = dist <= mm
            if not any_order:
                near &= (g[None, :] < h[cut, None]) | ((g[None, :] == h[cut, None]) & (others[None, :] < own[cut, None]))
            found[cut] = near.any(1)
        return pd.DataFrame({"node_id": own[found]})

    return _near_cubes(targets, sources, mm, 1, MOST, multiply, f"node_id {dict(targets.dtypes)['node_id']}")[0].distinct()


def gaussian(sigma: float) -> Product:
    """Sums of Gaussian weights (first) and of weighted source vectors."""

    def product(dist: np.ndarray, _: np.ndarray, v: np.ndarray) -> np.ndarray:
        w = np.exp(-(dist**2) / (2 * sigma * sigma))
        return np.hstack([w.sum(1, keepdims=True), w @ v])

    return product


def gaussian_smooth(maps: DataFrame, nodes: DataFrame, mm: float, sigma: float) -> DataFrame:
    """node_id, value: means of the values of all nodes within mm, with Gaussian weights of their distance; nodes without a value have no part."""
    held = maps.filter(F.col("value").isNotNull()).select("node_id", F.array(F.col("value").cast("double")).alias("v")).join(nodes.select("node_id", *"xyz"), "node_id")
    return near_sums(held, held, mm, gaussian(sigma), 1).select("node_id", (F.col("s")[1] / F.col("s")[0]).alias("value"))


def _present(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values with 0 for missing ones (NaN), and ones where there is a value."""
    seen = ~np.isnan(v)
    return np.where(seen, v, 0.0), seen.astype(float)


def near_means(targets: DataFrame, sources: DataFrame, mm: float) -> DataFrame:
    """node_id, x: the mean vector of the sources within mm; an entry that is null in all of them is null."""

    def product(dist: np.ndarray, _: np.ndarray, v: np.ndarray) -> np.ndarray:
        near = np.isfinite(dist).astype(float)
        value, seen = _present(v)
        return np.hstack([near @ value, near @ seen])

    sums = near_sums(targets, sources, mm, product)
    half = F.size("s") / 2
    return sums.select("node_id", F.zip_with(F.slice("s", 1, half.cast("int")), F.slice("s", (half + 1).cast("int"), half.cast("int")), lambda a, n: F.when(n > 0, a / n)).alias("x"))


def sparse_product(weights: DataFrame, vectors: DataFrame, most: int = MOST) -> DataFrame:
    """node_id, ts: for each target (dst) the mean of its sources' vectors by the weights (src, dst, w), entry by entry over the sources that have one.

    Targets are dealt to blocks by ranges of ids; a source's vector goes once to each block with a target of it, where a matrix of weights meets a matrix of
    vectors. Blocks with more than MOST sources are cut into pieces by source and their partial sums are added.
    """
    w = weights.select("src", F.col("dst").alias("node_id"), F.col("w").cast("double").alias("w"), F.floor(F.col("dst") / most).alias("b"))
    need = w.select("b", F.col("src").alias("other")).distinct()
    sizes, some = _pieces(need.select("b"), ["b"], "q")

    def cut(rows: DataFrame, node: str) -> DataFrame:
        rows = rows.join(sizes, ["b"], "left").withColumn("q", F.coalesce("q", F.lit(1))) if some else rows.withColumn("q", F.lit(1))
        return rows.withColumn("q", F.pmod(F.xxhash64(node), F.col("q")).cast("int"))

    right = cut(need, "other").join(vectors.select(F.col("node_id").alias("other"), "ts"), "other").select("other", "ts", F.col("b").alias("_b"), F.col("q").alias("_q"))

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("other")
        a = a[a["src"].isin(b["other"])].sort_values("node_id", kind="stable")
        if not len(a):
            return _sums_frame(np.zeros(0, np.int64), [])
        value, seen = _present(_stack(b["ts"]))
        both = np.hstack([value, seen])
        rows = np.searchsorted(b["other"].to_numpy(), a["src"].to_numpy())
        ids, first = np.unique(a["node_id"].to_numpy(), return_index=True)
        ends, out = [*first[1:], len(a)], []
        for lo, hi in zip(first, ends):
            weight, total = a["w"].to_numpy()[lo:hi], np.zeros(both.shape[1])
            for k in range(0, hi - lo, step := max(1, CELLS // both.shape[1])):
                total += weight[k : k + step] @ both[rows[lo + k : min(hi, lo + k + step)]]
            out.append(total)
        return _sums_frame(ids, out)

    kind = dict(weights.dtypes)["dst"]
    parts = cut(w, "src").groupBy("b", "q").cogroup(right.groupBy("_b", "_q")).applyInPandas(multiply, f"node_id {kind}, s array<double>")
    half = (F.size("s") / 2).cast("int")
    ratio: Column = F.zip_with(F.slice("s", 1, half), F.slice("s", half + 1, half), lambda a, n: F.when(n != 0, a / n))
    return _summed(parts, some).select("node_id", ratio.alias("ts"))


def edge_sums(edges: DataFrame, targets: DataFrame, sources: DataFrame, product: Callable[[np.ndarray, np.ndarray], np.ndarray], most: int = MOST) -> DataFrame:
    """node_id, s (array<double>): for each target (src of edges) the sum over its edges of product(tv, sv), a row of numbers for each edge.

    targets and sources: node_id, v. Edges stay pairs of ids: targets are dealt to blocks by ranges of ids, and each block gets the vectors of the nodes
    that its edges name once. Blocks with more than MOST sources are cut into pieces by source.
    """
    e = edges.select("src", "dst", F.floor(F.col("src") / most).alias("b"))
    need = e.select("b", F.col("dst").alias("node_id")).distinct()
    sizes, some = _pieces(need.select("b"), ["b"], "q")

    def cut(rows: DataFrame, node: str) -> DataFrame:
        rows = rows.join(sizes, ["b"], "left").withColumn("q", F.coalesce("q", F.lit(1))) if some else rows.withColumn("q", F.lit(1))
        return rows.withColumn("q", F.pmod(F.xxhash64(node), F.col("q")).cast("int"))

    e = cut(e, "dst")
    right = cut(need, "node_id").join(sources.select("node_id", "v"), "node_id").withColumn("own", F.lit(False))
    left = e.select("b", "q", F.col("src").alias("node_id")).distinct().join(targets.select("node_id", "v"), "node_id").withColumn("own", F.lit(True))
    both = right.unionByName(left).select(F.col("b").alias("_b"), F.col("q").alias("_q"), "node_id", "v", "own")

    def multiply(pairs: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        t, s = nodes[nodes["own"]].sort_values("node_id"), nodes[~nodes["own"]].sort_values("node_id")
        pairs = pairs[pairs["src"].isin(t["node_id"]) & pairs["dst"].isin(s["node_id"])].sort_values("src")
        if not len(pairs):
            return _sums_frame(np.zeros(0, np.int64), [])
        tv, sv = _stack(t["v"]), _stack(s["v"])
        ti, si = np.searchsorted(t["node_id"].to_numpy(), pairs["src"].to_numpy()), np.searchsorted(s["node_id"].to_numpy(), pairs["dst"].to_numpy())
        total, step = None, max(1, CELLS // max(tv.shape[1], sv.shape[1]))
        for k in range(0, len(ti), step):
            made = product(tv[ti[k : k + step]], sv[si[k : k + step]])
            total = np.zeros((len(t), made.shape[1])) if total is None else total
            np.add.at(total, ti[k : k + step], made)
        named = np.unique(ti)
        return _sums_frame(t["node_id"].to_numpy()[named], list(total[named]))

    kind = dict(targets.dtypes)["node_id"]
    parts = e.groupBy("b", "q").cogroup(both.groupBy("_b", "_q")).applyInPandas(multiply, f"node_id {kind}, s array<double>")
    return _summed(parts, some)
