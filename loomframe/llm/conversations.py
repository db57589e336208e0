"""Conversation structure repair: the cheapest edits that make the roles of a conversation s?(ua)+, and the audit of these edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cmp_to_key

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import Workspace, row_numbers, spread_join, stored, table

#: What the last repaired turn is: none yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAULTS = ("", "blank", "duplicate", "truncated")
#: Edits of one turn with the inserts before it. An insert before a deleted turn is never cheapest-and-least: it may as well follow the deletion.
SYMBOLS = ("D", "IIK", "IIR", "IK", "IR", "K", "R")
#: Conversations of more turns or text bytes than these are cut into blocks of turns, FAN blocks to a larger block.
LONG_TURNS, LONG_BYTES, BLOCK, FAN = 4096, 64 << 20, 4096, 1024
#: Long conversations whose keys are broadcast at most; with more, the table is joined by shuffling.
BROADCAST_ROWS = 100_000
_BASE, _MOD = 1_000_003, (1 << 61) - 1

#: A way through one turn or block: state before, state after, cost, rank of its audit among the ways of this turn or block.
Way = tuple[int, int, int, int]


class Audits:
    """Audits as linked nodes that share their prefixes: a node is its prefix's node and one more symbol.

    Every node knows its ancestors 1, 2, 4, ... symbols back and a rolling hash of all its symbols. Audits of equally many symbols are compared
    at the symbol behind their longest common prefix, which the hashes find by binary lifting; a prefix held by two different nodes is
    verified symbol by symbol. All audits up to the same turn have equally many symbols.
    """

    def __init__(self) -> None:
        self.up: list[list[int]] = [[]]
        self.symbol, self.hash, self.way = [0], [0], [(0, 0)]

    def add(self, before: int, symbol: int, way: tuple[int, int]) -> int:
        up, k = [before], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(up)
        self.symbol.append(symbol)
        self.hash.append((self.hash[before] * _BASE + symbol + 1) % _MOD)
        self.way.append(way)
        return len(self.up) - 1

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth hold the same audit, beyond their hashes."""
        while x != y:
            if self.symbol[x] != self.symbol[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def compare(self, x: int, y: int) -> int:
        """Less than, equal to or more than 0 as audit x stands before, with or behind y."""
        if x == y or (self.hash[x] == self.hash[y] and self.same(x, y)):
            return 0
        a, b = x, y
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self.symbol[a] != self.symbol[b] and self.same(self.up[a][0], self.up[b][0]):
            return self.symbol[a] - self.symbol[b]
        left, right = ([self.symbol[n] for n in self.line(z)] for z in (x, y))
        return (left > right) - (left < right)

    def line(self, x: int) -> list[int]:
        """The nodes from the first symbol to x."""
        out = []
        while x:
            out.append(x)
            x = self.up[x][0]
        return out[::-1]


def _ways(initial: str, forced: bool, truncated: bool) -> list[Way]:
    """Ways through a turn of a role initial; a forced one can only be deleted."""
    out = [(s, s, DELETE, SYMBOLS.index("D")) for s in range(4)]
    if not forced:
        for s in range(4):
            for inserts in range(3 if s in (START, SYSTEM) else 2):
                at = s if not inserts else (USER, ASSISTANT)[(inserts - 1) % 2] if s != USER else ASSISTANT
                to = ASSISTANT if at == USER else USER
                cost = INSERT * inserts + TRUNCATED * truncated
                out.append((s, to, cost + REROLE, SYMBOLS.index("I" * inserts + "R")))
                if initial == "sua"[to - 1]:
                    out.append((s, to, cost + KEEP, SYMBOLS.index("I" * inserts + "K")))
        if initial == "s":
            out.append((START, SYSTEM, KEEP + TRUNCATED * truncated, SYMBOLS.index("K")))
    return out


TURN_WAYS = {(i, fault): _ways(i, fault in (1, 2), fault == 3) for i in ("s", "u", "a", "") for fault in range(4)}


def through(items: Iterable[list[Way]], start: int, pool: Audits) -> dict[int, tuple[int, int]]:
    """For each state that can be reached over all items: the least cost, and the least audit (a node) of that cost."""
    now = {start: (0, 0)}
    for ways in items:
        best: dict[int, tuple[int, int, int, int]] = {}
        for frm, to, cost, rank in ways:
            if frm not in now:
                continue
            total, node = now[frm][0] + cost, now[frm][1]
            old = best.get(to)
            if old is None or total < old[0] or (total == old[0] and (rank < old[2] if node == old[1] else (pool.compare(node, old[1]) or rank - old[2]) < 0)):
                best[to] = (total, node, rank, frm)
        now = {to: (total, pool.add(node, rank, (frm, to))) for to, (total, node, rank, frm) in best.items()}
    return now


#: Inserts that complete a conversation from each state.
CLOSING = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}


def best_end(ends: dict[int, tuple[int, int]], pool: Audits) -> int:
    """The state from which the whole conversation is cheapest, with the least audit."""
    cost = lambda e: ends[e][0] + INSERT * CLOSING[e]
    return min(ends, key=cmp_to_key(lambda a, b: cost(a) - cost(b) or pool.compare(ends[a][1], ends[b][1])))


def summary(items: list[list[Way]]) -> list[Way]:
    """The ways through all items as the ways through one block: audits become their ranks among the block's audits."""
    pool = Audits()
    found = [(s, e, c, n) for s in range(4) for e, (c, n) in through(items, s, pool).items()]
    nodes = sorted({n for *_, n in found}, key=cmp_to_key(pool.compare))
    rank, last = {}, -1
    for k, n in enumerate(nodes):
        last += not k or pool.compare(nodes[k - 1], n) != 0
        rank[n] = last
    return [(s, e, c, rank[n]) for s, e, c, n in found]


def chosen(items: list[list[Way]], start: int, end: int | None) -> list[tuple[int, int, int]]:
    """(state before, state after, symbol) for each item, on the best way from start to end (None: to the best end)."""
    pool = Audits()
    ends = through(items, start, pool)
    node = ends[best_end(ends, pool) if end is None else end][1]
    return [(*pool.way[n], pool.symbol[n]) for n in pool.line(node)]


def repaired(role: str, text: str, frm: int, to: int, symbol: str) -> list[tuple[str, str, str]]:
    """(role, text, edit) of the turns that a turn becomes: inserts, then the turn unless deleted."""
    out, state = [], frm
    for edit in symbol:
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and to == SYSTEM else ASSISTANT if state == USER else USER
        name = "user" if state == USER else "assistant"
        out.append((role, text, "K") if edit == "K" else (name, "" if edit == "I" else text, edit))
    return out


class Report:
    """Counts, cost, audit and digest of one conversation, from its turns in order, one at a time."""

    FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def __init__(self) -> None:
        self.turns: list[int] = []  # the smallest and the largest
        self.distinct = self.illegal = self.cost = 0
        self.faults = [0] * 4
        self.audit: list[str] = []
        self.sha, self.lines, self.initial, self.state = hashlib.sha256(), 0, None, START

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def add(self, turn: int | None, role: str, text: str, fault: int, frm: int, to: int, symbol: str) -> None:
        if turn is not None:
            self.distinct += not self.turns or turn != self.turns[1]
            self.turns = [self.turns[0] if self.turns else turn, turn]
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.faults[fault] += 1
        self.audit.append(symbol)
        kept = symbol[-1] != "D"
        self.cost += INSERT * symbol.count("I") + {"K": KEEP, "R": REROLE, "D": DELETE}[symbol[-1]] + TRUNCATED * (kept and fault == 3)
        for r, t, _ in repaired(role, text, frm, to, symbol):
            self.line(r, t)
        self.state = to

    def closed(self) -> tuple:
        inserts = CLOSING[self.state]
        for role in ("user", "assistant")[2 - inserts :]:
            self.line(role, "")
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return (gaps, *self.faults[1:], self.illegal, self.cost + INSERT * inserts, "".join(self.audit) + "I" * inserts, self.sha.hexdigest())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_COUNTS = [(n.split(" ")[0], pa.int64() if n.endswith("long") else pa.string()) for n in Report.FIELDS.split(", ")]
_TURNS = "place long, step int, turn {turn}, role string, text string, edit string, fault string"


def _output(kind: pa.DataType, turn: pa.DataType, reports: bool) -> pa.Schema:
    more = _COUNTS if reports else [("place", pa.int64()), ("step", pa.int32()), ("turn", turn), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string()), ("fault", pa.string())]
    return pa.schema([("conv_id", kind), *more])


class Emitter:
    """Turns of one conversation after another, with their edits, into reports or repaired turns."""

    def __init__(self, schema: pa.Schema, reports: bool):
        self.schema, self.reports, self.report, self.place, self.rows, self.size, self.conv = schema, reports, None, 0, [], 0, None

    def add(self, conv: object, turn: object, role: str, text: str, fault: int, way: tuple[int, int, int]) -> None:
        if self.report is None:
            self.conv, self.report, self.place, self.state = conv, Report() if self.reports else True, 0, START
        frm, to, symbol = way[0], way[1], SYMBOLS[way[2]]
        if self.reports:
            self.report.add(turn, role, text, fault, frm, to, symbol)
        else:
            done = repaired(role, text, frm, to, symbol)
            done = done if symbol[-1] != "D" else [*done, (role, text, "D")]
            for step, (r, t, edit) in enumerate(done):
                own = edit != "I"
                self.rows.append((conv, self.place, step, turn if own else None, r, t, edit, FAULTS[fault] if own else ""))
                self.size += len(t)
            self.state = to
        self.place += 1

    def end(self) -> None:
        if self.report is None:
            return
        if self.reports:
            self.rows.append((self.conv, *self.report.closed()))
            self.size += len(self.rows[-1][-2])
        else:
            for step, role in enumerate(("user", "assistant")[2 - CLOSING[self.state] :]):
                self.rows.append((self.conv, self.place, step, None, role, "", "I", ""))
        self.report = None

    def full(self, all_: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (all_ or len(self.rows) >= 5000 or self.size > 16 << 20):
            yield _batch(self.rows, self.schema)
            self.rows, self.size = [], 0


def _whole(reports: bool):
    """Conversations that fit into memory, from rows in order: conv_id, turn, role, text, fault (0, 1 or 3 as yet), mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, first = [], None, True

        def flush() -> None:
            seen, turns = set(), []
            for conv, turn, role, text, fault, mark in held:
                turns.append((conv, turn, role, text, 2 if fault != 1 and mark in seen else fault))
                seen.add(mark)
            ways = chosen([TURN_WAYS[t[2][:1] if t[2][:1] in ("s", "u", "a") else "", t[4]] for t in turns], START, None)
            for t, way in zip(turns, ways):
                out.add(*t, way)
            out.end()
            held.clear()

        for batch in batches:
            out = out or Emitter(_output(batch.schema.field(0).type, batch.schema.field(1).type, reports), reports)
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[0] != held[0][0]:
                    flush()
                    yield from out.full()
                held.append(row)
        if held:
            flush()
            yield from out.full(True)
        elif out:
            yield from out.full(True)

    return run


def _streamed(reports: bool):
    """Conversations of any length, from rows in order with their ways: conv_id, turn, role, text, fault, frm, to, symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            out = out or Emitter(_output(batch.schema.field(0).type, batch.schema.field(1).type, reports), reports)
            for conv, turn, role, text, fault, frm, to, symbol in zip(*[c.to_pylist() for c in batch.columns]):
                if out.report is not None and conv != out.conv:
                    out.end()
                out.add(conv, turn, role, text, fault, (frm, to, symbol))
                yield from out.full()
        if out:
            out.end()
            yield from out.full(True)

    return run


_ARRAYS = "frm array<int>, to array<int>, cost array<long>, rank array<int>"


def _items(group: pd.DataFrame, by: str) -> list[list[Way]]:
    g = group.sort_values(by)
    return [list(zip(*(map(int, c) for c in row))) for row in zip(g["frm"], g["to"], g["cost"], g["rank"])]


def _turn_items(group: pd.DataFrame) -> list[list[Way]]:
    g = group.sort_values("pos")
    return [TURN_WAYS[i, int(f)] for i, f in zip(g["initial"], g["fault"])]


def _summed(blocks: DataFrame, level: str, by: str, turns: bool = False) -> DataFrame:
    """ck, level and the ways through each block of rows of that level."""

    def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ways = summary(_turn_items(group) if turns else _items(group, by))
        return pd.DataFrame({"ck": [key[0]], level: [key[1]], **{n: [list(c)] for n, c in zip(("frm", "to", "cost", "rank"), zip(*ways))}})

    return blocks.groupBy("ck", level).applyInPandas(one, f"ck string, {level} long, {_ARRAYS}")


def _descended(inside: DataFrame, picks: DataFrame, level: str, by: str, turns: bool = False) -> DataFrame:
    """ck, by, frm, to, symbol of the items in blocks of a level, from the states before and after each block (picks: ck, level, frm, to)."""

    def one(rows: pd.DataFrame, pick: pd.DataFrame) -> pd.DataFrame:
        ways = chosen(_turn_items(rows) if turns else _items(rows, by), int(pick["frm"].iloc[0]), int(pick["to"].iloc[0]))
        return pd.DataFrame({"ck": rows["ck"].iloc[0], by: rows[by].sort_values().to_numpy(), "frm": [w[0] for w in ways], "to": [w[1] for w in ways], "symbol": [w[2] for w in ways]})

    held = inside.select("ck", level, by, *(("initial", "fault") if turns else ("frm", "to", "cost", "rank")))
    return held.groupBy("ck", level).cogroup(picks.select("ck", level, "frm", "to").groupBy("ck", level)).applyInPandas(one, f"ck string, {by} long, frm int, to int, symbol int")


def _long_ways(turns: DataFrame, space: Workspace) -> DataFrame:
    """Rows of long conversations in order (ck, pos) with fault, frm, to and symbol.

    Turns are numbered over ranges of (conversation, turn, role, text), so no task gets a whole conversation. The ways through blocks of turns, then through
    blocks of blocks, are summed up to one table of at most FAN blocks a conversation; there the best is chosen, and the choice goes down again.
    """
    ck = F.to_json(F.struct(F.col("conv_id").cast("string").alias("c")))
    order = ["conv_id", "turn", "role", "text", "_tie"]
    # identical rows are interchangeable, whichever comes first
    ranged = turns.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    placed = space.stored(ranged.withColumns({"ck": ck, "_at": F.monotonically_increasing_id()}), "placed")
    narrow = space.stored(row_numbers(placed.select("ck", "_at", "mark", "fault", F.substring("role", 1, 1).alias("initial"), F.col("_at").alias("at")), ["ck"], "pos"), "turns")
    first = space.stored(narrow.groupBy("ck", "mark").agg(F.min("pos").alias("first")), "first")
    fault = F.when((F.col("fault") != 1) & (F.col("pos") > F.col("first")), 2).otherwise(F.col("fault"))
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("")
    marked = spread_join(narrow, first, ["ck", "mark"]).select("ck", "at", "pos", F.floor(F.col("pos") / BLOCK).alias("b0"), initial.alias("initial"), fault.cast("int").alias("fault"))
    levels = [space.stored(marked, "marked")]
    sums = space.stored(_summed(levels[0], "b0", "pos", True), "sums0")
    while (sums.groupBy("ck").count().agg(F.max("count")).first()[0] or 0) > FAN:
        k = len(levels)
        levels.append(sums.withColumn(f"b{k}", F.floor(F.col(f"b{k - 1}") / FAN)))
        sums = space.stored(_summed(levels[-1], f"b{k}", f"b{k - 1}"), f"sums{k}")
    top = f"b{len(levels) - 1}"

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        ways = chosen(_items(rows, top), START, None)
        return pd.DataFrame({"ck": rows["ck"].iloc[0], top: rows[top].sort_values().to_numpy(), "frm": [w[0] for w in ways], "to": [w[1] for w in ways]})

    picks = space.stored(sums.groupBy("ck").applyInPandas(best, f"ck string, {top} long, frm int, to int"), "picks")
    for k in range(len(levels) - 1, 0, -1):
        picks = space.stored(_descended(levels[k], picks, f"b{k}", f"b{k - 1}"), "picks")
    ways = _descended(levels[0], picks, "b0", "pos", True)
    edits = levels[0].select("ck", "pos", "at", "fault").join(ways, ["ck", "pos"]).select("pos", "at", F.col("fault").alias("found"), "frm", "to", "symbol")
    return placed.join(edits, F.col("_at") == F.col("at")).select("ck", "pos", "conv_id", "turn", "role", "text", F.col("found").alias("fault"), "frm", "to", "symbol")


def _edited(turns: DataFrame, reports: bool, space: Workspace) -> DataFrame:
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    body = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(body == "", 1).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    # role and text as one key: the role's length tells where the text begins
    mark = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumns({"fault": fault, "mark": mark})
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("text").cast("long")).alias("_b"))
    long_ = space.stored(sizes.filter((F.col("_n") > LONG_TURNS) | (F.col("_b") > LONG_BYTES)).select(F.col("conv_id").alias("_c")), "long")
    several = long_.count()
    kinds = dict(turns.dtypes)
    schema = f"conv_id {kinds['conv_id']}, " + (Report.FIELDS if reports else _TURNS.format(turn=kinds["turn"]))
    keys = F.broadcast(long_) if several <= BROADCAST_ROWS else long_
    same = F.col("conv_id").eqNullSafe(F.col("_c"))
    short = rows.join(keys, same, "left_anti") if several else rows
    sorted_ = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    out = sorted_.select("conv_id", "turn", "role", "text", "fault", "mark").mapInArrow(_whole(reports), schema)
    if several:
        ways = _long_ways(rows.join(keys, same, "left_semi"), space)
        ordered = ways.repartition("ck").sortWithinPartitions("ck", "pos").select("conv_id", "turn", "role", "text", "fault", "frm", "to", "symbol")
        out = out.unionByName(ordered.mapInArrow(_streamed(reports), schema))
    return out


_CONTRACT = """Of each conversation's turns by turn (nulls first; equal ones by role and text), the first fault counts: blank, duplicate (role and text seen
    earlier in it), truncated (the last character that isn't white space is none of . ! ?). Edits: K keeps a turn (0), R makes it user or assistant (1), D
    deletes it (2; blank and duplicate turns must go), I inserts an empty user or assistant turn (5); a truncated turn that stays costs 5
    more. Of the cheapest edits after which the roles' initials are s?(ua)+, or nothing is left, those stand whose initials come first in ASCII order.

    Null roles and texts count as one space; null conversations are one conversation; roles of other initials can only be made user or assistant, or go. Each
    distinct row of the table counts, so repeated rows are duplicates. An empty table gives an empty result; other columns are not read. A conversation
    of more than LONG_TURNS turns or LONG_BYTES bytes is repaired in blocks, of which no task holds more than one at a time; its turns pass
    through one task in order only for what the result says of the conversation as a whole."""


def conversation_audits(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conversation of turns (conv_id, turn, role, text)."""
    with Workspace(turns.sparkSession) as space:
        return stored(_edited(turns, True, space), "audits")


def repair_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, place, step, turn, role, text, edit, fault: the edited turns, in order of (place, step) in a conversation.

    place numbers the turns that were there, from 0; inserts before a turn have its place, those at the end the next one. Deleted turns are listed with the edit D.
    """
    with Workspace(turns.sparkSession) as space:
        return stored(_edited(turns, False, space), "repaired")


for _f in (conversation_audits, repair_conversations):
    _f.__doc__ = f"{_f.__doc__.rstrip()}\n\n    {_CONTRACT}\n    "


def damaged(turns: DataFrame) -> DataFrame:
    """turns as the contract damages them, by the CRC-32 of conv_id:turn: some dropped, emptied, without full stops, repeated, or made the user's."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    draw = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = turns.filter(draw != 0).select("conv_id", "turn", F.when(draw == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(draw == 3, 2).otherwise(1).alias("_n"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("_n"))).alias("_copy")).drop("_copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation, after damage."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    audits = conversation_audits(damaged(turns)).withColumnRenamed("conv_id", "_conv")
    ids = turns.select("conv_id").distinct()
    filled = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    text = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")]
    return ids.join(audits, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select("conv_id", *filled, *text)


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
#: DuckDB has no CRC-32; tests compare with brute force.
ORACLES: dict[str, str] = {}
