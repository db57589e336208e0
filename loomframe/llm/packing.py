"""Best-fit packing of documents into sequences by exact-complement hashing of length sums."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomframe.llm.bpe import map_tokens
from loomframe.llm.common import placed, row_numbers, table

CAPACITY = 2048
END_ID = 0
#: An entry of the plan: (length, first rank, repeats in a sequence, sequences, first sequence, offset).
Run = tuple[int, int, int, int, int, int]


def _complement(count: np.ndarray, gap: int) -> list[int]:
    """One, two or three available lengths whose sum is gap, large ones first; empty if there are none."""
    if gap <= 0:
        return []
    if count[gap]:
        return [gap]

    def pair(total: int, used: int = 0) -> list[int]:
        if total < 2:
            return []
        x = np.arange(1, total // 2 + 1)
        y = total - x
        have_x, have_y = count[x] - (x == used), count[y] - (y == used)
        ok = np.flatnonzero((have_x > 0) & (have_y > 0) & ((x != y) | (have_x > 1)))
        return [int(y[ok[0]]), int(x[ok[0]])] if len(ok) else []

    if two := pair(gap):
        return two
    for z in np.flatnonzero(count[: gap - 1])[::-1].tolist():
        if two := pair(gap - z, z):
            return [z, *two]
    return []


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Sequences for pieces of given lengths, from the number of pieces of each length alone.

    The longest length left opens a sequence. Its gap is looked up among the sums of one, two and three lengths that are still
    available; if none fills it exactly, the longest fitting length is put in (best fit) and the rest is looked up again.
    A combination is used for as many sequences as the counts allow. The input has at most capacity entries, so the
    plan's size depends on the capacity and not on the number of pieces.
    """
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] += n
    taken: Counter = Counter()
    runs: list[Run] = []
    sequence = 0
    while count.any():
        left = count.copy()
        longest = int(np.flatnonzero(left)[-1])
        items = [longest]
        left[longest] -= 1
        gap = capacity - longest
        while gap:
            exact = _complement(left, gap)
            if not exact:
                fitting = np.flatnonzero(left[: gap + 1])
                if not len(fitting):
                    break
                # several of the same length at once, but so that a complement can still be found for what remains
                exact = [int(fitting[-1])]
            for x in exact:
                left[x] -= 1
            items += exact
            gap -= sum(exact)
        uses = Counter(items)
        times = int(min(count[x] // n for x, n in uses.items()))
        offset = 0
        for x in sorted(uses, reverse=True):
            runs.append((x, taken[x], uses[x], times, sequence, offset))
            taken[x] += uses[x] * times
            count[x] -= uses[x] * times
            offset += x * uses[x]
        sequence += times
    return runs


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the ids of every row followed by id 0.

    Only rows with more than capacity ids are cut; then the first piece takes the remainder. Null and empty texts have one id, repeated rows the
    same pieces; an empty table gives an empty table; texts may have any length. Other columns of docs aren't read.
    """

    def rows(doc_ids: list, coded: Iterator[tuple[np.ndarray, bytes]]) -> list[list]:
        out: list[list] = [[], [], [], [], []]
        for doc_id, (ids, _) in zip(doc_ids, coded):
            ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
            first = len(ids) % capacity or capacity
            edges = [0, *range(first, len(ids) + 1, capacity)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                for column, value in zip(out, (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))):
                    column.append(value)
        return out

    return map_tokens(docs, rows, "doc_id long, piece int, start long, length long, ids_crc32 long", path)


def assign(ranked: DataFrame, runs: list[Run]) -> DataFrame:
    """Adds sequence_id and offset to rows with length and rank (gapless from 0 within a length)."""
    by_length: dict[int, np.ndarray] = {}
    for length in {r[0] for r in runs}:
        by_length[length] = np.array(sorted(r[1:] for r in runs if r[0] == length), np.int64)
    plan_at = ranked.sparkSession.sparkContext.broadcast(by_length)
    names = [c for c in ranked.columns if c != "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                entry = plan_at.value[x]
                e = entry[np.searchsorted(entry[:, 0], rank[at], "right") - 1]
                inside = rank[at] - e[:, 0]
                sequence[at] = e[:, 3] + inside // e[:, 1]
                offset[at] = e[:, 4] + inside % e[:, 1] * x
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names] + [pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in ranked.dtypes if c != "rank")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every row of docs with their sequence_id and offset.

    The driver sees the number of pieces of each length (at most capacity numbers) and plans with them; rows get their
    place by their rank among the pieces of their length. Repeated rows and ids are packed as often as they occur.
    """
    pieces = placed(token_pieces(docs, path, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    return assign(row_numbers(pieces, ["length"]), plan(histogram, capacity))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


QUERIES = {"op7_packing": op7_packing}
ORACLES: dict[str, str] = {}
