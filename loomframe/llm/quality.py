"""Quality rules as a short-circuit cascade, in DataFrame expressions only."""

from __future__ import annotations

import re
import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import SPACE, Sheltered, computed, table

#: Rows of the sample on which costs and rejection rates are measured: an upper bound, whatever the input's size.
SAMPLE_ROWS = 1000
#: Fixed characters of the contract: white space between words, and symbols.
BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: The class of white space as an SQL literal has it.
_SPACE = SPACE.replace("\\", "\\\\")


@dataclass(frozen=True)
class Rule:
    """reject: SQL over features; needs: the features that it reads."""

    name: str
    reject: str
    needs: tuple[str, ...]


#: The first and the last are the contract's base rules. The others reject what no clean prose shows.
RULES = [
    Rule("too_few_words", "n_words < 50", ("n_words",)),
    Rule("symbol_heavy", "n_symbols * 20 > word_chars", ("n_symbols", "word_chars")),
    Rule("odd_word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words", ("n_words", "word_chars")),
    Rule("repeated_lines", "n_dup_lines * 10 > 6 * n_lines", ("n_dup_lines", "n_lines")),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", ("n_words", "n_repeat_words")),
]
BASE = ("too_few_words", "repeated_words")
OUTPUT = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _let(name: str, value: str, body: str) -> str:
    """body with a name for value, which is computed once: a lambda over one element."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


_PLACE = "cast(keys[{0}] & (shiftleft(1L, bits) - 1) AS int)"
_EQUAL = " AND ".join(f"_words[{_PLACE.format('k')} + {j}] = _words[{_PLACE.format('k - 1')} + {j}]" for j in range(3))
#: Upper bits: a hash of the window; the lower bits (2 ** bits > number of words): its place.
_KEYS = "sort_array(transform(sequence(0, size(_words) - 3), i -> shiftleft(xxhash64(_words[i], _words[i + 1], _words[i + 2]), bits) | cast(i AS bigint)))"
#: 1: the window has the words of the one before in the order of keys; 2: only its hash.
_SAME = f"transform(sequence(1, size(keys) - 1), k -> CASE WHEN shiftright(keys[k], bits) <> shiftright(keys[k - 1], bits) THEN 0 WHEN {_EQUAL} THEN 1 ELSE 2 END)"
_TWICE = f"transform(filter(sequence(0, size(keys) - 1), k -> (k > 0 AND same[k - 1] = 1) OR (k < size(same) AND same[k] = 1)), k -> {_PLACE.format('k')})"
#: The same by windows sorted by their words, so that equal ones stand side by side.
_SORTED = "sort_array(transform(sequence(0, size(_words) - 3), i -> struct(_words[i] AS a, _words[i + 1] AS b, _words[i + 2] AS c, i AS i)))"
_TWICE_SORTED = _let("w", _SORTED, "transform(filter(w, (x, k) -> " + " OR ".join(f"({edge} AND x.a = w[k {step}].a AND x.b = w[k {step}].b AND x.c = w[k {step}].c)" for edge, step in (("k > 0", "- 1"), ("k < size(w) - 1", "+ 1"))) + "), x -> x.i)")
#: Words in windows at these places.
_COVERED = _let("at", f"sort_array(CASE WHEN array_contains(same, 2) THEN {_TWICE_SORTED} ELSE {_TWICE} END)", "aggregate(transform(at, (x, k) -> CASE WHEN k < size(at) - 1 THEN least(3, at[k + 1] - x) ELSE 3 END), 0L, (a, x) -> a + x)")

#: SQL of each feature over _t (the text, not null) and the features that it names; those with an underscore are steps on the way.
FEATURES: dict[str, tuple[tuple[str, ...], str]] = {
    "_words": ((), f"filter(split(_t, '{_SPACE}+'), w -> w <> '')"),
    "_lines": ((), r"filter(split(_t, '\\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]')"),
    "n_words": (("_words",), "cast(size(_words) AS bigint)"),
    "word_chars": ((), f"cast(length(translate(_t, '{BLANKS}', '')) AS bigint)"),
    "n_symbols": ((), f"cast(length(_t) - length(translate(_t, '{SYMBOLS}', '')) AS bigint)"),
    "n_lines": (("_lines",), "cast(size(_lines) AS bigint)"),
    "n_dup_lines": (("_lines",), "cast(size(_lines) - size(array_distinct(_lines)) AS bigint)"),
    "n_repeat_words": (("_words",), "CASE WHEN size(_words) < 4 THEN 0L ELSE " + _let("bits", "length(bin(size(_words)))", _let("keys", _KEYS, _let("same", _SAME, f"CASE WHEN array_max(same) = 0 THEN 0L ELSE {_COVERED} END"))) + " END"),
}


def with_features(df: DataFrame, names: Iterable[str], text: str) -> DataFrame:
    """df and the features named of its column text that it doesn't have yet, with the steps on the way.

    Each layer of features is computed once a row, behind a generator, so that it is evaluated neither again for what is built on it nor for
    rows that a filter above has dropped.
    """
    wanted: list[str] = []

    def want(name: str) -> None:
        if name not in df.columns and name not in wanted:
            for n in FEATURES[name][0]:
                want(n)
            wanted.append(name)

    for name in names:
        want(name)
    while wanted:
        layer = [n for n in wanted if not any(d in wanted for d in FEATURES[n][0])]
        df = computed(df.withColumns({n: F.expr(re.sub(r"\b_t\b", f"coalesce({text}, '')", FEATURES[n][1])) for n in layer}), layer)
        wanted = [n for n in wanted if n not in layer]
    return df


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long) of the whole text.

    Null texts count as empty. Windows of three words that occur twice or more are found by sorting one long per
    window (upper bits: hash of the window; lower bits: its place) and comparing the words of neighbours. Where two different windows
    share a hash, which long texts can have, the windows of that text are sorted by their words instead. The work is n log n in a text's words.
    """
    held = Sheltered(docs, {})
    return held.outside(with_features(held.inside, OUTPUT, held.own[docs.columns.index(text)]), {n: n for n in OUTPUT})


def measure_rules(docs: DataFrame, rules: list[Rule], text: str = "text") -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of every rule by itself, on the first SAMPLE_ROWS rows that are read.

    Seconds are those of a job that computes what the rule needs, less those of a job that only reads the texts. A limit at the top of a plan reads
    partitions one after another until it has its rows, and nothing is shuffled.
    """
    texts = docs.select(F.col(f"`{text}`").alias("_sample"))

    def timed(df: DataFrame, value: str) -> tuple[float, list[bool]]:
        began = time.perf_counter()
        rows = df.select(F.expr(value).alias("v")).limit(SAMPLE_ROWS).collect()
        return time.perf_counter() - began, [r["v"] for r in rows]

    base = min(timed(texts, "length(_sample) > 0")[0] for _ in range(2))
    out = []
    for r in rules:
        seconds, hits = timed(with_features(texts, r.needs, "_sample"), r.reject)
        out.append((r, max(seconds - base, 1e-3), (sum(hits) + 0.5) / (len(hits) + 1)))
    return out


def order_rules(docs: DataFrame, rules: list[Rule], text: str = "text") -> list[Rule]:
    """Rules by rejections per second on a bounded sample. The order changes the work, never the verdict."""
    return [r for r, *_ in sorted(measure_rules(docs, rules, text), key=lambda m: (-m[2] / m[1], m[0].name))]


def cascade(rules: list[Rule]) -> Column:
    """True for rows that no rule rejects. Rules are tried in order, and those behind the first that rejects aren't evaluated."""
    out = None
    for r in rules:
        out = F.when(F.expr(r.reject), False) if out is None else out.when(F.expr(r.reject), False)
    return F.lit(True) if out is None else out.otherwise(True)


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """Adds the features, base_failed and kept to every row of docs.

    All features are reported, so all are computed for every row and the order of the rules saves next to nothing here; ``keep_good`` is where it
    does. Empty and null texts fail ``too_few_words``; an empty table gives an empty table; repeated rows are judged alike; texts may have any
    length; columns of docs may have any name, and those with the name of an added one are replaced.
    """
    rules = RULES if rules is None else rules
    held = Sheltered(docs, {})
    featured = with_features(held.inside, OUTPUT, held.own[docs.columns.index(text)])
    base = " OR ".join(f"({r.reject})" for r in RULES if r.name in BASE)
    kept = cascade(order_rules(docs, rules, text))
    return held.outside(featured, {n: n for n in OUTPUT} | {"base_failed": F.expr(base), "kept": kept})


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows of docs that no rule rejects, with the columns of docs, whatever their names.

    A filter for each rule, the best in rejections per second first; what a rule needs is computed for the rows that still stand.
    Edge cases are those of ``quality_rules``.
    """
    held = Sheltered(docs, {})
    left = held.inside
    for r in order_rules(docs, RULES if rules is None else rules, text):
        left = with_features(left, r.needs, held.own[docs.columns.index(text)]).filter(~F.expr(r.reject))
    return held.outside(left, {})


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: SQL for (r, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words); r numbers the rows of {source}.
FEATURES_SQL = """
_d AS (SELECT row_number() OVER () AS r, *, coalesce(text, '') AS t FROM {source}),
_w AS (SELECT r, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
       list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls, t FROM _d),
_t AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM _w)),
_m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS c FROM _t) WHERE c >= 2),
_p AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM _m) GROUP BY r),
_f AS (SELECT _w.r, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
       (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
       (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
       FROM _w LEFT JOIN _p ON _p.r = _w.r)
"""
KEPT_SQL = "NOT (" + " OR ".join(f"({r.reject})" for r in RULES) + ")"
ORACLE = f"""
WITH {FEATURES_SQL.format(source="documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, {KEPT_SQL} AS kept
FROM _d JOIN _f USING (r)
"""
QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES = {"op8_quality_rules": ORACLE}
