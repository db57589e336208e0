"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import Sheltered, placed, row_numbers, table, text_or_empty

#: A leaf of the tree: (region, rack, shard, weight).
Leaf = tuple[str, str, int, float]


def standard_tree(shards: int, base: int = 40, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """Shards below ``base`` stand in regions of ``racks`` racks; every shard added later forms a region of its own.

    So the tree for n + 1 >= base + 1 shards differs from the tree for n by one more child of the root, and only the
    rows that the new child draws move.
    """
    full = per_rack * racks
    grouped = min(base, shards) // full * full
    return [(f"r{s // full}", f"k{s // per_rack}", s, 1.0) if s < grouped else (f"g{s}", f"g{s}", s, 1.0) for s in range(shards)]


def _draw(key: Column, node: str, weight: float) -> Column:
    """An exponential draw of rate weight; of all children the smallest wins, each with probability weight / sum."""
    unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(unit) / F.lit(float(weight))


def _level(df: DataFrame, key: Column, parent: str, tree: dict[str, dict[str, float]], out: str) -> DataFrame:
    """Picks a child of the node in column parent; every parent's children draw under their own names."""
    pick = None
    for node, children in tree.items():
        names = F.array(*[F.lit(c) for c in children])
        best = F.array_min(F.array(*[F.struct(_draw(key, f"{node}/{c}", w).alias("d"), F.lit(i).alias("i")) for i, (c, w) in enumerate(children.items())]))["i"]
        chosen = F.lit(next(iter(children))) if len(children) == 1 else F.element_at(names, best + 1)
        pick = F.when(F.col(parent) == node, chosen) if pick is None else pick.when(F.col(parent) == node, chosen)
    return df.withColumn(out, pick)


def hash_tree_shard(df: DataFrame, key: Column, tree: list[Leaf], out: str = "shard") -> DataFrame:
    """Adds the shard of every row: region, rack and shard are drawn in turn, weighted by the leaves below each node.

    A node's draws depend on the key and on the child's name only. When the weight of one child changes, a row
    either stays below its old child or moves to (from) that child, so movement is confined to the subtree that
    changed. Leaves with weight 0 or less take no rows. A null key is a key of its own. Nothing is shuffled. Repeated rows get the same shard, an empty
    table gives an empty table; columns of df may have any name, and one with the name of the added one is replaced.
    """
    regions: dict[str, float] = defaultdict(float)
    racks: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    leaves: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for region, rack, shard, weight in tree:
        if weight > 0:
            regions[region] += weight
            racks[region][f"{region}/{rack}"] += weight
            leaves[f"{region}/{rack}"][str(shard)] += weight
    if not regions:
        raise ValueError("the tree has no leaf with a positive weight")
    held = Sheltered(df, {"_tree_key": key, "_tree_root": F.lit("root")})
    drawn = F.col("_tree_key")
    rows = _level(held.inside, drawn, "_tree_root", {"root": dict(regions)}, "_tree_region")
    rows = _level(rows, drawn, "_tree_region", racks, "_tree_rack")
    return held.outside(_level(rows, drawn, "_tree_rack", leaves, "_tree_leaf"), {out: F.col("_tree_leaf").cast("int")})


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document; law is ``key``.

    Null texts have size 16 and the checksum of the empty text; null and repeated doc_ids are hashed like others, so
    repeated ids share a shard. slot numbers a shard's rows from 0 without gathering a shard in one task. An empty table gives an empty
    table; texts may have any length; other columns of docs are not read.
    """
    text = text_or_empty()
    thin = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    key = F.col("doc_id")
    thin = hash_tree_shard(thin, key, standard_tree(shards))
    thin = hash_tree_shard(thin, key, standard_tree(shards + 1), "grown_shard")
    slots = row_numbers(placed(thin, "shards"), ["shard"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op4_sharding": op4_sharding}
ORACLES: dict[str, str] = {}
