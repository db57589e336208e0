"""Secrets: base rules, and literals that a lexer finds assigned to sensitive names, with constants propagated."""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomframe.llm.common import table

KINDS = ("assign", "access", "hex", "literal")
#: Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Name parts and how much they say about the literal; two parts in a row count as one name.
SENSITIVE = {
    "password": 2.0, "passwd": 2.0, "pwd": 2.0, "passphrase": 2.0, "secret": 2.0, "apikey": 2.0, "privatekey": 2.0, "secretkey": 2.0,
    "accesskey": 2.0, "signingkey": 1.8, "encryptionkey": 1.8, "token": 1.6, "authtoken": 2.0, "credential": 1.6, "credentials": 1.6, "bearer": 1.5, "auth": 0.8, "key": 0.6,
}
PLACEHOLDER = re.compile(r"example|changeme|placeholder|your|dummy|xxxx|\*\*\*|<[^<>]*>|\$\{|\{\{|^(?:none|null|true|false|undefined)$", re.IGNORECASE)
#: A literal with at least this score is a secret.
LEAST_SCORE = 3.0
#: From this length on a random literal is a secret under the weakest names too.
LONG = 20
_MIXED = re.compile(r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")
_PLACEHOLDER_AT = re.compile(f"(?={PLACEHOLDER.pattern})", re.IGNORECASE)

#: What the lexer stops at: a name before an operator, an opening quote (with a prefix, or escaped), a comment, a tag with text. Runs are
#: possessive and begin at their first character, so time stays linear.
_EVENT = re.compile(
    r"""(?<![\w.\-])(?<!\w')[0-9.\-]*+(?P<name>[A-Za-z_][\w.\-]*+)[\])]?[ \t]*+(?P<op>:=|=>|={1,3}|:)"""
    r"""|(?<!\w)(?:[rRbBuUfF]{1,2}+(?=["']))?(?P<quote>\"{3}|'{3}|\\?["']|`)"""
    r"""|(?P<line>(?<!\S)(?:\#|//|--[ ])|^[ \t]*+;)|(?P<block>(?<![\w:/])/\*)"""
    r"""|<(?P<tag>[A-Za-z_][\w.\-]*+)>(?P<inner>[^<>\n]++)</""",
    re.ASCII | re.MULTILINE,
)
#: After a quoted key; after a name and a colon, when a type and the value follow; between the parts of a concatenation.
_AFTER_KEY = re.compile(r"[\])]?[ \t]*+(:=|=>|={1,3}|:)")
_TYPED = re.compile(r"[ \t]*+[A-Za-z_][\w.\[\], |]*+=(?!=)", re.ASCII)
_LAST = re.compile(r"[\w.]+(?=[\], |]*=\Z)", re.ASCII)
_LEAD = re.compile(r"[ \t(]*+(?:\\?\r?\n[ \t(]*+)?")
_JOIN = re.compile(r"[ \t\r\n\\)(]*+(?:\+|\.\.?)[ \t\r\n\\(]*+|[ \t]++|(?<=[\"'])(?=[\"'])")
_JOIN_OPEN = re.compile(r"[ \t\r\n\\)(]*+(?:\+|\.\.?)[ \t\r\n\\(]*+|[ \t\r\n\\]++|(?<=[\"'])(?=[\"'])")
_QUOTE = re.compile(r"""(?:[rRbBuUfF]{1,2}+(?=["']))?(\"{3}|'{3}|\\?["']|`)""")
_END = {'"': re.compile(r'(?:[^"\\\n]|\\.)*+"'), "'": re.compile(r"(?:[^'\\\n]|\\.)*+'"), "`": re.compile(r"[^`\n]*+`"), '\\"': re.compile(r'[^"\\\n]*+\\"'), "\\'": re.compile(r"[^'\\\n]*+\\'")}
#: What opens a block of YAML text, behind the colon.
_FOLDED = re.compile(r"[ \t]*+[|>][+-]?[0-9]?[ \t]*+\r?\n(?=[ \t\r\n])")
_INDENT = re.compile(r"^([ \t]*+)(\S?)[^\n]*+", re.MULTILINE)
_BARE = re.compile(r"""[^\s"',;(){}\[\]<>]++""")
_REFERENCE = re.compile(r"[A-Za-z_][\w.\-]*+", re.ASCII)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds; matches that are too short are dropped."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PART.findall(name)]
    return max([0.0, *(SENSITIVE.get(p, 0) for p in parts), *(SENSITIVE.get(a + b, 0) for a, b in zip(parts, parts[1:]))])


def literal_score(value: str) -> float:
    """0 to 2.5: mixed character kinds, entropy and, for long ones, digits among letters; short literals and placeholders get less than nothing."""
    if len(value) < 8 or PLACEHOLDER.search(value):
        return -9.0
    return _counts_score(Counter(value), sum(1 for _ in _MIXED.finditer(value)))


def _counts_score(counts: Counter, mixed: int) -> float:
    """mixed: places where a letter and a digit meet."""
    n, characters = counts.total(), "".join(counts)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = sum(bool(re.search(p, characters)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    random = n >= LONG and entropy >= 3.0 and mixed >= n / 10
    return min(1.0, entropy / 3.5) + (0.5 if kinds >= 2 else -0.5) + (0.5 if re.search("[0-9]", characters) else 0.0) + (0.5 if random else 0.0)


def tail_scores(text: str, starts: list[int], end: int) -> dict[int, float]:
    """literal_score of text[start:end] for each start; each character is counted once."""
    if len(starts) == 1:
        return {starts[0]: literal_score(text[starts[0] : end])}
    held = max((m.start() for m in _PLACEHOLDER_AT.finditer(text, min(starts), end)), default=-1)
    meet = [m.start() for m in _MIXED.finditer(text, min(starts), end)]
    counts: Counter = Counter()
    out, at = {}, end
    for s in sorted(starts, reverse=True):
        counts.update(text[s:at])
        at = s
        out[s] = literal_score(text[s:end]) if end - s < 16 else -9.0 if held >= s else _counts_score(counts, len(meet) - bisect_left(meet, s))
    return out


@dataclass
class Assignment:
    """A name and the expression it gets: pieces of literals (start, end), and names. A comparison or a comment defines no constant."""

    name: str
    at: int
    defines: bool
    pieces: list[tuple[int, int]] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    quoted: bool = True


class Lexer:
    """Assignments of source and configuration text, in one pass.

    Strings (one line, triple, back-quoted, escaped quotes inside another string), comments, typed and chained assignments, quoted keys,
    concatenations, YAML blocks and tags with text are told apart. A quote opens a string only where a word doesn't end, so that apostrophes of prose
    don't; one that isn't closed is an ordinary character, and so are its like up to the line's end. What a string or a block holds is lexed in its turn,
    quoted keys of any length included. What a search has found behind a place is kept, so that time stays linear.
    """

    def __init__(self, text: str):
        self.text, self.out = text, []
        self.dead: dict[str, int] = {}
        self.blocks: dict[int, int] | None = None
        todo = [(0, len(text), False)]
        while todo:
            todo += self._region(*todo.pop())

    def _block_end(self, line: int) -> int:
        """Where the lines that are indented deeper than the line from a place end, blank ones between them included. All lines are measured once."""
        if self.blocks is None:
            self.blocks, deeper = {}, []
            for m in [*_INDENT.finditer(self.text)][::-1]:
                if m[2]:
                    depth, stop = len(m[1]), min(m.end() + 1, len(self.text))
                    while deeper and deeper[-1][0] > depth:
                        stop = max(stop, deeper.pop()[1])
                    self.blocks[m.start()] = stop
                    deeper.append((depth, stop))
        return self.blocks.get(line, line)

    def _next(self, what: str, at: int, end: int) -> int:
        """The first place of a mark from at on, or end; one that was found further on needs no search."""
        place = self.ahead.get(what, -1)
        if place < at:
            found = self.text.find(what, at, end)
            place = self.ahead[what] = found if found >= 0 else end
        return place

    def _string(self, at: int, end: int) -> tuple[int, int, int] | None:
        """(start, end, place after) of the string whose quote stands at a place."""
        m = _QUOTE.match(self.text, at, end)
        if not m or self.dead.get(m[1], -1) > at:
            return None
        if len(m[1]) == 3:
            close = self.text.find(m[1], m.end(), end)
            if close >= 0:
                return m.end(), close, close + 3
            self.dead[m[1]] = end
            return None
        close = _END[m[1]].match(self.text, m.end(), end)
        if close and not (close.end() < end and (self.text[close.end()].isalnum() or self.text[close.end()] == "_")):
            return m.end(), close.end() - len(m[1]), close.end()
        line = self.text.find("\n", m.end(), end)
        # where it isn't closed, no quote of the kind opens a string on the rest of the line
        self.dead[m[1]] = m.end() if close else line if line >= 0 else end
        return None

    def _expression(self, into: Assignment, at: int, end: int) -> tuple[int, list[tuple[int, int]]]:
        """Reads the terms of an expression; the place after them, and the strings that it holds."""
        strings = []
        lead = _LEAD.match(self.text, at, end)
        at, joint = lead.end(), _JOIN_OPEN if "(" in lead[0] else _JOIN
        while True:
            if found := self._string(at, end):
                into.pieces.append(found[:2])
                strings.append(found[:2])
                after = found[2]
            elif (word := _REFERENCE.match(self.text, at, end)) and not self.text.startswith("(", word.end()):
                # a longer bare literal that begins like a name isn't one
                if word.end() < end and self.text[word.end()] != "+" and _BARE.match(self.text, word.end(), word.end() + 1):
                    break
                into.names.append(word[0].rstrip("."))
                after = word.end()
            else:
                break
            join = joint.match(self.text, after, end)
            at = after
            if not join or not (self.text[join.start() : join.end()].strip(" \t\r\n\\()") or _QUOTE.match(self.text, join.end(), end)):
                break
            at = join.end()
        return at, strings

    def _assign(self, name: str, start: int, op: str, at: int, end: int, comment: bool) -> tuple[int, list[tuple[int, int]]]:
        text = self.text
        also = None
        if op == ":" and (typed := _TYPED.match(text, at, end)):
            # a type, or (after a word of prose) the name itself
            op, at, also = "=", typed.end(), _LAST.search(typed[0])[0]
        into = Assignment(name, start, not comment and op not in ("==", "==="))
        if op == ":" and (block := _FOLDED.match(text, at, end)):
            stop = min(end, self._block_end(text.rfind("\n", 0, start) + 1))
            if stop > block.end():
                into.pieces.append((block.end(), stop))
                self.out.append(into)
            return block.end(), []
        after, strings = self._expression(into, at, end)
        if not strings:
            begin = _LEAD.match(text, at, end).end()
            bare = _BARE.match(text, begin, end) if begin >= self.until else None
            if bare:
                self.until = bare.end()
            if not bare and begin >= self.until or text.startswith("//", begin):
                return at, []
            into.pieces, into.quoted = [(begin, self.until)], False
            after = at
        self.out.append(into)
        if also:
            self.out.append(Assignment(also, at, into.defines, into.pieces, into.names, into.quoted))
        return after, strings

    def _region(self, start: int, end: int, comment: bool) -> list[tuple[int, int, bool]]:
        text, at, note = self.text, start, end if comment else -1
        self.until, self.dead, self.ahead = 0, {}, {}
        inner: list[tuple[int, int, bool]] = []
        key = None
        while m := _EVENT.search(text, at, end):
            inside = m.start() < note
            strings: list[tuple[int, int]] = []
            if m["name"]:
                at, strings = self._assign(m["name"], m.start("name"), m["op"], m.end(), end, inside)
            elif m["quote"]:
                found = self._string(m.start(), end)
                if not found:
                    at = m.end() if len(m["quote"]) < 3 else m.start("quote") + 1
                    continue
                at = found[2]
                key = _AFTER_KEY.match(text, at, end)
                if key and "\n" not in text[found[0] : found[1]]:
                    at, strings = self._assign(text[found[0] : found[1]], found[0], key[1], key.end(), end, inside)
                strings = [*strings, found[:2]]
            elif m["tag"]:
                self.out.append(Assignment(m["tag"], m.start(), False, [m.span("inner")]))
                at = m.end("inner")
            elif m["line"]:
                note, at = max(note, self._next("\n", m.end(), end)), m.end()
            else:
                close = self._next("*/", m.end(), end)
                note, at = max(note, close if close < end else m.end()), m.end()
            inner += [(a, b, inside) for a, b in strings if b - a >= 10 and ("=" in text[a:b] or ":" in text[a:b])]
        return inner


def scored_literals(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals; one that a sensitive name gets through constants, in any order, counts under that name."""
    found = Lexer(text).out
    own = [name_score(a.name) for a in found]
    if not any(own):
        return []
    defined: dict[str, list[int]] = {}
    for i in sorted((i for i, a in enumerate(found) if a.defines and (a.quoted or a.names)), key=lambda i: found[i].at):
        defined.setdefault(found[i].name, []).append(i)
    best = [0.0] * len(found)
    # the best names first, so that a constant is reached once
    for i in sorted((i for i, x in enumerate(own) if x), key=lambda i: -own[i]):
        todo, score = [i], own[i]
        while todo:
            k = todo.pop()
            if best[k] >= score:
                continue
            best[k] = score
            for name in found[k].names:
                if every := defined.get(name):
                    # the definition before the use, else the first one
                    before = bisect_left(every, found[k].at, key=lambda j: found[j].at)
                    todo.append(every[before - 1 if before else 0])
    out: dict[tuple[int, int], float] = {}
    bare: dict[int, dict[int, float]] = {}
    for a, score in zip(found, best):
        if not score or not a.pieces or (a.names and not a.quoted and any(n in defined for n in a.names)):
            continue
        if a.quoted:
            span = a.pieces[0][0], a.pieces[-1][1]
            out[span] = max(out.get(span, 0), score + literal_score("".join(text[s:e] for s, e in a.pieces)))
        else:
            (s, e), held = a.pieces[0], bare.setdefault(a.pieces[0][1], {})
            held[s] = max(held.get(s, 0), score)
    for e, held in bare.items():
        for s, x in tail_scores(text, list(held), e).items():
            out[s, e] = max(out.get((s, e), 0), held[s] + x)
    return sorted((s, e, x) for (s, e), x in out.items())


def find_secrets(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, spans that the method adds): literals of LEAST_SCORE that no base span contains."""
    base = base_spans(text)
    if "=" not in text and ":" not in text and "</" not in text:
        return base, []
    starts, reach = [s for s, _, _ in base], [*accumulate((e for _, e, _ in base), max)]

    def held(s: int, e: int) -> bool:
        before = bisect_right(starts, s)
        return before > 0 and reach[before - 1] >= e

    return base, [(s, e, "literal") for s, e, x in scored_literals(text) if x >= LEAST_SCORE and not held(s, e)]


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of s, e, kind) of every row; null texts count as empty.

    A text is scanned where it stands, whole and in linear time; nothing is shuffled, repeated rows are scanned alike, and an empty table gives
    an empty table. Other columns of docs aren't read.
    """
    span = "array<struct<s:int,e:int,kind:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                base, every = [], []
                for text in part.column(1).to_pylist():
                    own, extra = find_secrets(text or "")
                    base.append([dict(zip(("s", "e", "kind"), x)) for x in own])
                    every.append([dict(zip(("s", "e", "kind"), x)) for x in sorted([*own, *extra], key=lambda s: (s[0], KINDS.index(s[2])))])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(base, kind), pa.array(every, kind)], ["doc_id", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, base {span}, spans {span}")


def mask_secrets(text: str | None, mark: str = "[secret]") -> str | None:
    """text with every span replaced by mark; overlapping spans become one mark."""
    if text is None:
        return None
    base, extra = find_secrets(text)
    if not base and not extra:
        return text
    out, at = [], 0
    for s, e, _ in sorted([*base, *extra]):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs, all rows and columns whatever their names, with the secrets in text replaced by a mark; null texts stay null."""
    at = docs.columns.index(text)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([mask_secrets(t) for t in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    found = scan_secrets(table(spark, sf_dir, "documents"))

    def joined(column: str):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES = {"op9_secret_scan": op9_secret_scan}
ORACLES: dict[str, str] = {}
