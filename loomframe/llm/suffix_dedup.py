"""Repeated passages: sparse suffixes sorted in front-coded runs, merged by loser trees that carry common prefixes."""

from __future__ import annotations

from bisect import bisect_right
from hashlib import blake2b
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.anchors import SEED, WINDOW, anchors, digests
from loomframe.llm.common import Workspace, numbered, stored, table
from loomframe.llm.shingles import mix, slices

REACH = WINDOW - SEED
#: The (row, position) of a string that stands for no anchor.
GHOST = (-1, -2)
#: Strings of an anchor at position a: forward from a - REACH and from a, backward from a + WINDOW and from a + SEED.
FAMILIES = b"ABYZ"
#: A task sorts so many strings into one run, a range of the exchange has about so many, and so many strings a range are looked at to choose the ranges.
RUN_STRINGS, RANGE_STRINGS, SAMPLE = 120_000, 120_000, 16


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (x.bit_length() + 7) // 8


class Run:
    """A sorted run read from its front coding: each string is the common part with the one before, and the rest."""

    def __init__(self, shared: np.ndarray, rests: list[bytes], extra: list):
        self.shared, self.rests, self.extra, self.at, self.text = shared.tolist(), rests, extra, -1, b""

    def advance(self) -> int:
        """Moves to the next string; its common prefix with the one before, -1 at the end."""
        self.at += 1
        if self.at >= len(self.rests):
            return -1
        n = self.shared[self.at]
        self.text = self.text[:n] + self.rests[self.at]
        return n


def merge(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, index, common prefix with the string before) in sorted order, by a loser tree.

    Every loser keeps the length of its common prefix with the string that beat it. That string was put out, or stands above the
    loser; so of two strings the one with the longer common prefix with the last output is smaller, and only on equal lengths are
    bytes compared, from that length on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    known = [r.advance() for r in runs] + [-1] * (k - len(runs))
    known = [0 if h >= 0 else -1 for h in known]
    texts = [r.text for r in runs] + [b""] * (k - len(runs))
    loser = [0] * k

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser)"""
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        h = known[i]
        if h < 0:
            return i, j
        a, b = texts[i], texts[j]
        c = h + common_prefix(a[h:], b[h:])
        if a[c : c + 1] <= b[c : c + 1]:
            known[j] = c
            return i, j
        known[i] = c
        return j, i

    winners = list(range(k))
    level = k
    while level > 1:
        level //= 2
        nxt = []
        for n in range(level):
            w, x = play(winners[2 * n], winners[2 * n + 1])
            loser[level + n] = x
            nxt.append(w)
        winners = nxt
    best = winners[0]
    while known[best] >= 0:
        yield best, runs[best].at, known[best]
        known[best] = runs[best].advance()
        texts[best] = runs[best].text
        node = (best + k) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def anchor_table(docs: DataFrame) -> DataFrame:
    """_row, pos, lo, hi, seed, c1, c2 of every anchor: its place, the first and last start of its windows, a hash of the seed, and 128
    cryptographic bits of the whole stretch that its windows cover. Positions are bytes from the text's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_row", "pos", "lo", "hi", "seed", "c1", "c2"]
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for first, data, edges in slices(batch.column(1)):
                a, lo, hi, seed = anchors(data, edges)
                text = np.searchsorted(edges, a, "right") - 1
                start = edges[text]
                two = np.frombuffer(b"".join(digests(data, lo, hi + WINDOW)), np.int64).reshape(-1, 2)
                columns = [rows[first + text], (a - start).astype(np.int32), (lo - start).astype(np.int32), (hi - start).astype(np.int32), seed.view(np.int64), two[:, 0], two[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return docs.select("_row", "text").mapInArrow(run, "_row long, pos int, lo int, hi int, seed long, c1 long, c2 long")


def _strings(text: bytes, a: int) -> list[tuple[int, bytes]]:
    """(family, string) of the anchor at a."""
    left, n = max(0, a - REACH), len(text)
    out = [(1, text[a : a + WINDOW]), (3, text[left : a + SEED][::-1])]
    if a >= REACH:
        out.append((0, text[left : a + WINDOW]))
    if a + WINDOW <= n:
        out.append((2, text[left : a + WINDOW][::-1]))
    return [(f, FAMILIES[f : f + 1] + s) for f, s in out]


def _splitters(texts: DataFrame, strings: int, ranges: int) -> list[bytes]:
    """Where the ranges of the exchange begin: whole strings, from SAMPLE strings a range that a hash picks among those of all rows.

    texts: (_row, text, at). The driver gets SAMPLE * ranges strings of at most 2 * WINDOW - SEED + 1 bytes, whatever a range holds.
    """
    share = min(1.0, SAMPLE * ranges / max(strings, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = np.array(batch.column(2)[i].as_py(), np.uint64)
                drawn = mix(mix(at + np.uint64(1)) ^ np.uint64(batch.column(0)[i].as_py()))
                # an anchor has four strings, of which its hash takes one
                some = np.flatnonzero((drawn >> np.uint64(11)).astype(float) < 4 * share * 2.0**53)
                if len(some):
                    raw = batch.column(1)[i].as_py().encode()
                    out = []
                    for k in some.tolist():
                        every = _strings(raw, int(at[k]))
                        out += [s for _, s in every] if share == 1.0 else [every[int(drawn[k]) % len(every)][1]]
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["s"])

    seen = sorted(r["s"] for r in texts.mapInArrow(run, "s binary").collect())
    return sorted({bytes(seen[len(seen) * i // ranges]) for i in range(1, ranges)}) if seen else []


def sorted_runs(texts: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Blocks of sorted, front-coded runs: bucket, shared, lengths, rests, rows, positions. One string of equal ones is sent.

    Where a run holds a string twice, its anchors are known to repeat it whole: their rows (bucket -1, with shared as family and
    lengths as common prefix) need no merging, and the string goes on without an anchor. A range also gets each run's last string before it
    and first string after it, without an anchor, if they share more with the splitter than a seed: so common prefixes are exact across ranges.
    """

    def coded(bucket: int, keys: list[bytes], marks: list[tuple[int, int]]) -> dict:
        shared = [0, *[common_prefix(x, y) for x, y in zip(keys, keys[1:])]]
        rests = [s[n:] for s, n in zip(keys, shared)]
        return {
            "bucket": bucket, "shared": np.array(shared, "<u2").tobytes(), "lengths": np.array([len(x) for x in rests], "<u2").tobytes(), "rests": b"".join(rests),
            "rows": np.array([m[0] for m in marks], "<i8").tobytes(), "positions": np.array([m[1] for m in marks], "<i4").tobytes(),
        }

    def flush(held: list[tuple[bytes, int, int]]) -> Iterator[dict]:
        held.sort(key=lambda x: x[0])
        keys: list[bytes] = []
        members: list[list[tuple[int, int]]] = []
        for s, row, pos in held:
            if keys and keys[-1] == s:
                members[-1].append((row, pos))
            else:
                keys.append(s)
                members.append([(row, pos)])
        done = [(r, p, FAMILIES.index(k[0]), len(k) - 1) for k, m in zip(keys, members) if len(m) > 1 for r, p in m]
        for i in range(0, len(done), 20_000):
            r, p, f, n = zip(*done[i : i + 20_000])
            yield {"bucket": -1, "shared": np.array(f, "<u2").tobytes(), "lengths": np.array(n, "<u2").tobytes(), "rests": b"", "rows": np.array(r, "<i8").tobytes(), "positions": np.array(p, "<i4").tobytes()}
        marks = [m[0] if len(m) == 1 else GHOST for m in members]
        edges = [0, *[bisect_right(keys, s) for s in splitters], len(keys)]
        for b, (i, j) in enumerate(zip(edges, edges[1:])):
            before = [keys[i - 1]] if b and i and common_prefix(keys[i - 1], splitters[b - 1]) > SEED else []
            after = [keys[j]] if b < len(splitters) and j < len(keys) and common_prefix(keys[j], splitters[b]) > SEED else []
            if i < j or before or after:
                yield coded(b, [*before, *keys[i:j], *after], [*[GHOST] * len(before), *marks[i:j], *[GHOST] * len(after)])

    schema = "bucket int, shared binary, lengths binary, rests binary, rows binary, positions binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int]] = []
        kinds = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("shared", "lengths", "rests", "rows", "positions")])
        for batch in batches:
            for i in range(batch.num_rows):
                row, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().encode()
                for a in batch.column(2)[i].as_py():
                    held += [(s, row, a) for _, s in _strings(text, a)]
                    if len(held) >= RUN_STRINGS:
                        yield pa.RecordBatch.from_pylist(list(flush(held)), kinds)
                        held = []
        if held:
            yield pa.RecordBatch.from_pylist(list(flush(held)), kinds)

    return texts.mapInArrow(run, schema)


def longest_matches(blocks: DataFrame, parts: int) -> DataFrame:
    """_row, pos, family, n: the longest common prefix of each anchor's string with any other string of its family."""

    def results(block: dict) -> pa.RecordBatch:
        columns = [np.frombuffer(block["rows"], "<i8"), np.frombuffer(block["positions"], "<i4"), np.frombuffer(block["shared"], "<u2").astype(np.int32), np.frombuffer(block["lengths"], "<u2").astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_row", "pos", "family", "n"])

    def merged(group: list[dict]) -> pa.RecordBatch:
        runs = []
        for block in group:
            ends = np.cumsum(np.frombuffer(block["lengths"], "<u2").astype(np.int64)).tolist()
            rests = [block["rests"][i:j] for i, j in zip([0, *ends], ends)]
            runs.append(Run(np.frombuffer(block["shared"], "<u2"), rests, list(zip(np.frombuffer(block["rows"], "<i8").tolist(), np.frombuffer(block["positions"], "<i4").tolist()))))
        out: tuple[list, list, list, list] = ([], [], [], [])
        last = None
        before = 0

        def put(after: int) -> None:
            (row, pos), family = last
            if pos >= 0:
                for column, v in zip(out, (row, pos, family, max(before, after, 1) - 1)):
                    column.append(v)

        for r, i, h in merge(runs):
            if last is not None:
                put(h)
            last, before = (runs[r].extra[i], FAMILIES.index(runs[r].text[0])), h
        if last is not None:
            put(0)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["_row", "pos", "family", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                block = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                if block["bucket"] < 0:
                    yield results(block)
                    continue
                if group and group[0]["bucket"] != block["bucket"]:
                    yield merged(group)
                    group = []
                group.append(block)
        if group:
            yield merged(group)

    own = F.when(F.col("bucket") < 0, -1 - F.abs(F.hash("rows") % parts)).otherwise(F.col("bucket"))
    dealt = blocks.withColumn("_to", own).repartition(parts, "_to").sortWithinPartitions("bucket").drop("_to")
    return dealt.mapInArrow(run, "_row long, pos int, family int, n int")


def window_hashes(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """h1, h2 (128 cryptographic bits), _row, s, mine of the windows asked for: rows (_row, pos, from, to, mine_from, mine_to) of offsets before the anchor."""
    lists = asked.groupBy("_row").agg(F.collect_list(F.struct("pos", "from", "to", "mine_from", "mine_to")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h1", "h2", "_row", "s", "mine"]
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode()
                spots: dict[int, bool] = {}
                for x in batch.column(2)[i].as_py():
                    for o in range(x["from"], x["to"] + 1):
                        s = x["pos"] - o
                        if 0 <= s <= len(raw) - WINDOW:
                            spots[s] = spots.get(s, False) or x["mine_from"] <= o <= x["mine_to"]
                two = np.frombuffer(b"".join(blake2b(raw[s : s + WINDOW], digest_size=16).digest() for s in spots), np.int64).reshape(-1, 2)
                columns = [two[:, 0], two[:, 1], np.full(len(spots), batch.column(0)[i].as_py(), np.int64), np.array(list(spots), np.int32), np.array(list(spots.values()), bool)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return texts.select("_row", "text").join(lists, "_row").select("_row", "text", "asked").mapInArrow(run, "h1 long, h2 long, _row long, s int, mine boolean")


def repeated_starts(docs: DataFrame) -> DataFrame:
    """(_row, lo, hi): ranges of starts of windows of WINDOW bytes that also start elsewhere. docs: (_row, text).

    1. Equal windows have their anchor at the same place, so only windows of anchors whose seed occurs twice can repeat.
    2. If every anchor of a seed covers the same stretch, or another anchor covers the same stretch as this one, all its windows repeat.
    3. For the rest, the longest matches of four strings around the anchor (from the merged suffix runs) settle which windows repeat:
       a match forward from the left end or backward from the right end covers windows; a match from the seed outwards bounds them.
    4. Windows that the bounds leave open (short passages with different text on both sides) are compared one by one.
    Stretches and windows are compared by 128-bit cryptographic digests, strings in 3 by their bytes. The 64-bit hash of a seed only brings
    anchors together: different seeds with one hash have different stretches and share no more than their bytes do.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with Workspace(spark) as space:
        table_ = space.stored(anchor_table(docs), "all")
        seeds = table_.groupBy("seed").agg(F.count(F.lit(1)).alias("_n"), ((F.min("c1") != F.max("c1")) | (F.min("c2") != F.max("c2"))).alias("mixed")).filter("_n > 1").drop("_n")
        # stored, so that the join deals out both sides itself and can split a hot seed
        flagged = space.stored(table_.join(space.stored(seeds, "seeds"), "seed"), "anchors")
        plain = flagged.filter("NOT mixed").select("_row", "lo", "hi")
        mixed = flagged.filter("mixed").drop("mixed")
        groups = mixed.groupBy("c1", "c2").agg((F.count(F.lit(1)) > 1).alias("whole"), F.min(F.struct("_row", "pos")).alias("one"))
        mixed = mixed.join(space.stored(groups, "stretches"), ["c1", "c2"]).select("_row", "pos", "lo", "hi", "seed", "whole", (F.col("one") == F.struct("_row", "pos")).alias("one"))
        mixed = space.stored(mixed, "mixed")
        whole = mixed.filter("whole").select("_row", "lo", "hi")
        chosen = mixed.filter("one OR NOT whole")
        lists = chosen.groupBy("_row").agg(F.collect_list("pos").alias("at"))
        texts = space.stored(docs.select("_row", "text").join(lists, "_row").select("_row", "text", "at"), "texts")
        strings = 4 * chosen.count()
        splitters = _splitters(texts, strings, max(parts, -(-strings // RANGE_STRINGS)))
        found = longest_matches(sorted_runs(texts, splitters), max(parts, len(splitters) + 1))
        match = [F.coalesce(F.max(F.when(F.col("family") == f, F.col("n"))), F.lit(0)).alias(f"m{f}") for f in range(4)]
        open_ = chosen.filter("NOT whole").join(found.groupBy("_row", "pos").agg(*match), ["_row", "pos"])
        bounds = open_.select(
            "_row", "pos", "seed", "lo", "hi",
            F.least("hi", F.expr(f"pos - {REACH} + m0 - {WINDOW}")).alias("up"),
            F.greatest("lo", F.expr(f"pos + {WINDOW} - m2")).alias("down"),
            F.least("hi", F.expr(f"pos - {WINDOW} + m1")).alias("most"),
            F.greatest("lo", F.expr(f"pos + {SEED} - m3")).alias("least"),
        )
        bounds = space.stored(bounds, "bounds")
        covered = bounds.filter("up >= lo").select("_row", "lo", F.col("up").alias("hi")).unionByName(bounds.filter("down <= hi").select("_row", F.col("down").alias("lo"), "hi"))
        left = bounds.select("_row", "pos", "seed", F.greatest("least", F.col("up") + 1, "lo").alias("first"), F.least("most", F.col("down") - 1, "hi").alias("last")).filter("first <= last")
        left = space.stored(left.withColumns({"from": F.expr("pos - last"), "to": F.expr("pos - first")}), "left")
        span = space.stored(left.groupBy("seed").agg(F.min("from").alias("from"), F.max("to").alias("to")), "spans")
        mine = left.select("_row", "pos", F.col("from").alias("mine_from"), F.col("to").alias("mine_to"))
        asked = space.stored(chosen.select("_row", "pos", "seed").join(span, "seed").drop("seed"), "asked").join(mine, ["_row", "pos"], "left").na.fill({"mine_from": 1, "mine_to": 0})
        windows = space.stored(window_hashes(texts, asked), "windows")
        twice = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
        single = windows.filter("mine").join(space.stored(twice, "twice"), ["h1", "h2"]).select("_row", F.col("s").alias("lo"), F.col("s").alias("hi"))
        return stored(plain.unionByName(whole).unionByName(covered).unionByName(single), "repeated")


def cut_passages(docs: DataFrame, as_text: bool = False) -> DataFrame:
    """Adds kept (binary: the bytes that stay), n_bytes, n_removed and n_spans to docs (_row, text and others).

    as_text: kept is a string, without what a cut leaves of a character.

    Every byte of a window that also starts elsewhere goes, first occurrences included: of repeated rows all copies go. Null and empty
    texts have 0 bytes and stay; texts under WINDOW bytes stay whole; an empty table gives an empty table. A text of any length is looked at a
    step at a time; ranges of one text are gathered in one row, never those of several. Columns of docs keep their names, but for
    those with the name of an added one, which are replaced.
    """
    names = docs.columns
    own = [f"_own{i}" for i in range(len(names))]
    row, at = own[names.index("_row")], names.index("text")
    ranges = repeated_starts(docs.select("_row", "text")).groupBy(F.col("_row").alias(row)).agg(F.collect_list(F.struct("lo", "hi")).alias("_ranges"))
    joined = docs.select(*[F.col(f"`{n}`").alias(o) for n, o in zip(names, own)]).join(ranges, row, "left").select(*own, "_ranges")
    added = ["kept", "n_bytes", "n_removed", "n_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for text, found in zip(batch.column(at), batch.column(len(own))):
                raw = (text.as_py() or "").encode()
                cuts = sorted((x["lo"], x["hi"] + WINDOW) for x in found.as_py() or ())
                out, end, spans = [], 0, 0
                for lo, hi in cuts:
                    if lo > end or not spans:
                        out.append(raw[end:lo])
                        spans += 1
                    end = max(end, hi)
                out.append(raw[end:])
                left = b"".join(out)
                for column, v in zip((kept, n_bytes, n_removed, n_spans), (left.decode(errors="ignore") if as_text else left, len(raw), len(raw) - len(left), spans)):
                    column.append(v)
            columns = [pa.array(kept, pa.string() if as_text else pa.binary()), *[pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *columns], [*own, *added])

    schema = ", ".join(f"{o} {t}" for o, t in joined.dtypes[: len(own)])
    cut = joined.mapInArrow(run, f"{schema}, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long")
    return cut.select(*[F.col(o).alias(n) for o, n in zip(own, names) if n not in added], *added)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut_passages(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op6_suffix_dedup": op6_suffix_dedup}
ORACLES: dict[str, str] = {}
