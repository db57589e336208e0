"""Personal data: base rules, and candidate spans judged by boosted trees. DataFrame expressions only."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import Sheltered, computed, table

#: Fixed patterns of the base kinds. Runs are possessive and start at a run's first character (or where the last match
#: ended): the same matches as with plain repetition, in linear time and constant stack.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of this has none of the kind.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: High-recall generators of candidate spans; they may overlap the base spans and each other.
GENERATORS = {
    "number": r"\(?[0-9](?:[\x20().-]{0,2}+[0-9]){8,}+",
    "mail": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9.-]++",
}
#: Words that stand before personal numbers and addresses, and before numbers of things.
CONTEXT = r"(?i)(tel|phone|call|fax|mobile|card|visa|account|mail|contact|reach|write)[^A-Za-z0-9]{0,3}(no|number|nr|is|at|me|to)?[^A-Za-z0-9]{0,4}\z"
THINGS = r"(?i)(order|invoice|version|isbn|build|release|date|id|page|part|serial|ticket|since|between|total|ref)[^A-Za-z0-9]{0,3}(no|number|nr|is|of)?[^A-Za-z0-9]{0,4}\z"
#: Values of each feature: kind of generator, digits, groups of digits, most frequent separator, bracket, card checksum, word before, form of the first group.
FEATURES = {"mail": 2, "digits": 8, "groups": 5, "separator": 4, "paren": 2, "check": 2, "context": 3, "first": 4}
CELLS = math.prod(FEATURES.values())
#: Trees, their depth and learning rate.
ROUNDS, DEPTH, RATE = 60, 3, 0.3
#: Of what the threshold lets through, so much must be personal data by the held-out labels (positives and negatives weigh the same).
PRECISION = 0.98
#: Other ways to write a base match, by kind: (format, SQL over m, the base match). They are the positive labels; none of them is a base match.
VARIANTS = {
    "email": [("at", r"replace(m, '@', ' [at] ')"), ("at_round", r"replace(m, '@', '(at)')"), ("at_tight", r"replace(m, '@', '[at]')"), ("at_spaced", r"replace(m, '@', ' (at) ')")],
    "phone": [("local", r"regexp_replace(m, '^[+][0-9]+[ .-]*', '')"), ("dots", r"regexp_replace(regexp_replace(m, '[^0-9]+', '.'), '^[.]', '')"), ("dashes", r"regexp_replace(regexp_replace(m, '[^0-9]+', '-'), '^-', '')"), ("zeros", r"concat('00', substring(m, 2))")],
    "card": [("dotted", r"regexp_replace(substring(regexp_replace(m, '[^0-9]', ''), 1, 16), '([0-9]{4})(?=[0-9])', '$1.')"), ("mistyped", r"concat(substring(m, 1, length(m) - 1), cast((cast(right(m, 1) AS int) + 5) % 10 AS string))"), ("mistyped_grouped", r"regexp_replace(concat(substring(regexp_replace(m, '[^0-9]', ''), 1, 15), cast((cast(right(m, 1) AS int) + 3) % 10 AS string)), '([0-9]{4})(?=[0-9])', '$1 ')")],
}
#: Numbers of things, by SQL over h (a hash of the document, not negative): the negative labels.
NEGATIVES = [
    ("moment", "concat(1950 + h % 90, '-', lpad(1 + h % 12, 2, '0'), '-', lpad(1 + h % 28, 2, '0'), ' ', lpad(h % 24, 2, '0'), '.', lpad(h % 60, 2, '0'))"),
    ("isbn", "concat('978-', h % 10, '-', lpad(h % 100, 2, '0'), '-', lpad(h % 1000000, 6, '0'), '-', h % 7)"),
    ("version", "concat(h % 20, '.', h % 10, '.', lpad(h % 100000, 5, '0'), '.', lpad(h % 10000, 4, '0'))"),
    ("decimal", "concat(h % 10, '.', lpad(h % 100000000000, 11, '0'))"),
    ("thousands", "concat(1 + h % 900, ' ', lpad(h % 1000, 3, '0'), ' ', lpad(h % 997, 3, '0'), ' ', lpad(h % 991, 3, '0'))"),
    ("years", "concat(1900 + h % 100, '-', 1910 + h % 100, ' ', 1920 + h % 90)"),
    ("milliseconds", "concat('1', lpad(h % 1000000000000, 12, '0'))"),
    ("stamp", "concat(1950 + h % 90, lpad(1 + h % 12, 2, '0'), lpad(1 + h % 28, 2, '0'), lpad(h % 24, 2, '0'), lpad(h % 60, 2, '0'), lpad(h % 59, 2, '0'))"),
    ("serial", "concat(lpad(h % 100000, 5, '0'), '-', lpad(h % 99991, 5, '0'), '-', lpad(h % 99989, 5, '0'), '-', lpad(h % 99971, 5, '0'))"),
    ("digits_9_to_11", "lpad(h % 100000000000, 9 + cast(h % 3 AS int), '7')"),
    ("long_run", "repeat(lpad(h % 1000000000, 9, '4'), 3)"),
    ("at_word", "concat('price', '(at)', h % 100)"),
    ("handle", "concat('v', h % 10, '@', 'sha')"),
]
#: Items of a scan that are taken together.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: a lambda over one element."""
    return F.transform(F.array(value), body)[0]


def scan(items: Column, zero: Column, move: Callable[[Column, Column], Column], put: Callable[[Column, Column], Column], kind: str) -> Column:
    """put(state before x, x) for every x of items; the state begins at zero and goes on as move(state, x). kind: SQL type of what put gives.

    Blocks of items are gone through one by one, so that no array longer than a block (or than the number of blocks) is appended to.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def whole(v: Column) -> Column:
        part = lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK))
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        begin = F.aggregate(
            blocks, F.struct(zero.alias("at"), F.filter(F.array(zero), lambda z: F.lit(False)).alias("out")),
            lambda a, b: F.struct(F.aggregate(part(b), a["at"], move).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        )["out"]
        one = lambda b, at: F.aggregate(part(b), F.struct(at.alias("at"), none.alias("out")), lambda a, x: F.struct(move(a["at"], x).alias("at"), F.concat(a["out"], F.array(put(a["at"], x))).alias("out")))["out"]
        return F.when(F.size(v) == 0, none).otherwise(F.flatten(F.zip_with(blocks, begin, one)))

    return let(items, whole)


def spans(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: start and end (code points) and text of every match, in order."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = let(matches, lambda found: F.zip_with(found, F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda m, g: F.struct(F.length(g).alias("g"), m.alias("m"))))
    move = lambda at, x: at + x["g"] + F.length(x["m"])
    return scan(both, F.lit(0), move, lambda at, x: F.struct((at + x["g"]).alias("s"), move(at, x).alias("e"), x["m"].alias("m")), "struct<s:int,e:int,m:string>")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether the digits of d pass the check of payment cards."""
    def add(acc: Column, i: Column) -> Column:
        v = F.substring(d, i, F.lit(1)).cast("int") * (1 + (F.length(d) - i) % 2)
        return acc + F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), add) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|\z)){4}\z")
    d = digits(m)
    if kind == "card":
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(d).between(9, 15)
    return F.lit(True)


def _valid(kind: str) -> Column:
    return F.filter(f"_{kind}", lambda x: _holds(kind, x["m"]))


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """Adds a column of spans for each base kind."""
    t = F.col(text)
    none = F.expr("cast(array() as array<struct<s:int,e:int,m:string>>)")
    found = docs.withColumns({f"_{k}": F.when(t.rlike(HINT[k]), spans(t, p)).otherwise(none) for k, p in BASE.items()})
    return found.withColumns({f"_{k}": _valid(k) for k in BASE})


def _features(before: Column, m: Column, mail: bool) -> Column:
    """The cell of a candidate: its features as one number, in the order of FEATURES. before: the text before it."""
    n = F.length(digits(m))
    groups = F.length(F.regexp_replace(F.regexp_replace(m, "[0-9]++", "0"), "[^0]", ""))
    lead = F.length(F.regexp_extract(m, "[0-9]+", 0))
    separator = F.regexp_extract(m, r"[0-9]\)?([\x20.-])", 1)
    values = {
        "mail": F.lit(int(mail)),
        "digits": F.when(n < 9, 0).when(n < 12, 1).when(n < 13, 2).when(n < 15, 3).when(n < 16, 4).when(n < 17, 5).when(n < 20, 6).otherwise(7),
        "groups": F.least(F.greatest(groups, F.lit(1)) - 1, F.lit(4)),
        "separator": F.when(separator == "", 0).when(separator == " ", 1).when(separator == ".", 2).otherwise(3),
        "paren": (m.contains("(") | m.contains("[")).cast("int"),
        "check": F.lit(0) if mail else F.when(n.between(13, 19), luhn(digits(m))).otherwise(False).cast("int"),
        "context": F.when(before.rlike(CONTEXT), 2).when(before.rlike(THINGS), 1).otherwise(0),
        "first": F.when(lead == 0, 0).when(lead <= 3, 1).when(lead == 4, 2).otherwise(3) if not mail else (m.rlike(r"[A-Za-z0-9]\.[A-Za-z]{2,}")).cast("int"),
    }
    if mail:
        # what an address holds in digits says nothing
        values |= dict.fromkeys(("digits", "groups", "separator"), F.lit(0))
    cell = F.lit(0)
    for name, size in FEATURES.items():
        cell = cell * size + values[name]
    return cell


def _before(text: Column, s: Column) -> Column:
    return F.substring(text, F.greatest(s - 29, F.lit(1)), F.least(s, F.lit(30)))


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """Adds _candidates (s, e, cell) to a table with base spans: what the generators propose beside these.

    Candidates and base spans are sorted together; one scan forwards (the furthest end so far) and one backwards (the next start) tell
    which candidates overlap a base span.
    """
    t = F.col(text)
    none = F.expr("cast(array() as array<struct<s:int,e:int,m:string>>)")
    hint = {"number": r"[0-9][\x20().-]{0,2}[0-9]", "mail": r"@|[\[(]at[\])]"}
    out = docs.withColumns({f"_g_{g}": F.when(t.rlike(hint[g]), spans(t, p)).otherwise(none) for g, p in GENERATORS.items()})

    def event(g: int) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["s"].alias("s"), F.lit(g).alias("g"), x["e"].alias("e"))

    base = F.concat(*[F.transform(f"_{k}", event(0)) for k in BASE])
    events = F.array_sort(F.concat(base, *[F.transform(f"_g_{g}", event(i)) for i, g in enumerate(GENERATORS, 1)]))
    furthest = lambda end, x: F.when((x["g"] == 0) & (x["e"] > end), x["e"]).otherwise(end)
    kind = "struct<s:int,g:int,e:int,free:boolean>"
    ahead = scan(events, F.lit(-1), furthest, lambda end, x: F.struct(x["s"].alias("s"), x["g"].alias("g"), x["e"].alias("e"), ((x["g"] > 0) & (x["s"] >= end)).alias("free")), kind)
    nearest = lambda start, x: F.when(x["g"] == 0, x["s"]).otherwise(start)
    behind = scan(F.reverse(ahead), F.lit(2**31 - 1), nearest, lambda start, x: F.struct(x["s"].alias("s"), x["g"].alias("g"), x["e"].alias("e"), (x["free"] & (x["e"] <= start)).alias("free")), kind)
    free = F.filter(F.reverse(behind), lambda x: x["free"])
    some = F.when(F.size("_g_number") + F.size("_g_mail") > 0, free).otherwise(F.expr(f"cast(array() as array<{kind}>)"))
    cell = lambda x: F.when(x["g"] == 1, _features(_before(t, x["s"]), _within(t, x), False)).otherwise(_features(_before(t, x["s"]), _within(t, x), True))
    judged = F.transform(some, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), cell(x).alias("cell")))
    return out.withColumn("_candidates", judged).drop(*[f"_g_{g}" for g in GENERATORS])


def _within(text: Column, x: Column) -> Column:
    return F.substring(text, x["s"] + 1, x["e"] - x["s"])


def _values() -> np.ndarray:
    """CELLS x features: the value of each feature in each cell."""
    out, rest = [], np.arange(CELLS)
    for size in reversed(FEATURES.values()):
        out.append(rest % size)
        rest = rest // size
    return np.stack(out[::-1], 1)


class Trees:
    """Gradient-boosted trees of DEPTH (logistic loss) over the weights of positives and negatives in each feature cell.

    A node asks whether one feature has one value, or at least one. As cells are finitely many, the trees' sum is worked out once for every cell.
    """

    def __init__(self, positive: np.ndarray, negative: np.ndarray):
        grid = _values()
        self.questions = [(grid[:, f] == v) for f, n in enumerate(FEATURES.values()) for v in range(n)] + [(grid[:, f] >= v) for f, n in enumerate(FEATURES.values()) for v in range(1, n)]
        self.asked = np.stack(self.questions).astype(float)
        # a little of a negative in every cell: an unseen format isn't personal data until labels say so
        p, n = self._weights(positive), self._weights(negative) + 0.02
        self.margin = np.zeros(CELLS)
        self.splits = 0
        for _ in range(ROUNDS):
            q = 1 / (1 + np.exp(-self.margin))
            self.margin += RATE * self._tree(p - (p + n) * q, (p + n) * q * (1 - q), np.ones(CELLS, bool), DEPTH)

    @staticmethod
    def _weights(counts: np.ndarray) -> np.ndarray:
        """Both labels weigh the same."""
        return counts * (1000 / counts.sum()) if counts.sum() else counts

    def _tree(self, g: np.ndarray, h: np.ndarray, inside: np.ndarray, depth: int) -> np.ndarray:
        g, h = g * inside, h * inside
        value = np.where(inside, g.sum() / (h.sum() + 1), 0.0)
        if not depth:
            return value
        yes_g, yes_h = self.asked @ g, self.asked @ h
        gain = yes_g**2 / (yes_h + 1) + (g.sum() - yes_g) ** 2 / (h.sum() - yes_h + 1)
        best = int(gain.argmax())
        if gain[best] <= g.sum() ** 2 / (h.sum() + 1) + 1e-9:
            return value
        self.splits += 1
        yes = inside & self.questions[best]
        return self._tree(g, h, yes, depth - 1) + self._tree(g, h, inside & ~yes, depth - 1)

    def threshold(self, positive: np.ndarray, negative: np.ndarray) -> float:
        """The lowest margin above which PRECISION of the held-out weight is positive; infinite if there is none."""
        p, n = self._weights(positive), self._weights(negative)
        order = np.argsort(-self.margin, kind="stable")
        order = order[(p + n)[order] > 0]
        a, b = np.cumsum(p[order]), np.cumsum(n[order])
        good = np.flatnonzero((a >= PRECISION * (a + b)) & (self.margin[order] > 0))
        return float(self.margin[order[good[-1]]]) if len(good) else math.inf

    def accepted(self, least: float) -> list[int]:
        return np.flatnonzero(self.margin >= least).tolist()


def labelled(docs: DataFrame, text: str, formats: list[str] | None = None) -> DataFrame:
    """half, format, label, cell, n: counts of labelled candidates over all documents.

    Positives are base matches in other formats (VARIANTS), in the place where the match stands. Negatives are numbers of things (NEGATIVES), one a
    document, in a place that a hash picks. Both halves hold different documents, by a hash of the text. formats: only these.
    """
    t = F.col(text)
    known = base_spans(docs.select(F.col(text)), text).withColumns({"half": F.pmod(F.xxhash64(text), F.lit(2)).cast("int"), "h": F.shiftrightunsigned(F.xxhash64(text, F.lit(1)), 2)})
    choose = lambda every: [v for v in every if formats is None or v[0] in formats]
    match = lambda kind: F.transform(f"_{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), _before(t, x["s"]).alias("before"), x["m"].alias("m")))
    found = known.select("half", F.inline(F.concat(*[match(k) for k in VARIANTS])))
    written = [F.struct(F.lit(kind).alias("of"), F.lit(name).alias("format"), F.expr(f"CASE WHEN kind = '{kind}' THEN {sql} END").alias("w")) for kind, every in VARIANTS.items() for name, sql in choose(every)]
    columns = ["half", "format", "label", "mail", "before", "w"]
    rows = docs.sparkSession.createDataFrame([], "half int, format string, label int, mail boolean, before string, w string")
    if written:
        positive = found.select("half", "kind", "before", F.inline(F.array(*written))).filter("kind = of")
        rows = positive.withColumns({"label": F.lit(1), "mail": F.col("kind") == "email"}).select(*columns)
    things = choose(NEGATIVES)
    if things:
        case = "CASE h % {n} {when} END".format(n=len(things), when="{when}")
        pick = F.expr(case.format(when=" ".join(f"WHEN {k} THEN named_struct('format', '{name}', 'w', {sql}, 'mail', {str(name in ('at_word', 'handle')).lower()})" for k, (name, sql) in enumerate(things))))
        # a third of them stands after a word for things, a sixth after one for people
        word = F.expr("CASE WHEN h DIV 100 % 3 = 0 THEN ' order no. ' WHEN h DIV 100 % 6 = 1 THEN ' call ' ELSE ' ' END")
        place = F.concat(_before(t, (F.col("h") % F.greatest(F.length(t), F.lit(1))).cast("int")), word)
        negative = computed(known.select("half", pick.alias("x"), place.alias("before")), ["x"]).select("half", "x.format", F.lit(0).alias("label"), "x.mail", "before", "x.w")
        rows = rows.unionByName(negative)
    rows = computed(rows.select("half", "format", "label", "mail", "before", F.when(F.col("mail"), F.regexp_extract("w", GENERATORS["mail"], 0)).otherwise(F.regexp_extract("w", GENERATORS["number"], 0)).alias("m")), ["m"]).filter("m <> ''")
    cell = F.when(F.col("mail"), _features(F.col("before"), F.col("m"), True)).otherwise(_features(F.col("before"), F.col("m"), False))
    return rows.select("half", "format", "label", cell.alias("cell")).groupBy("half", "format", "label", "cell").agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, text: str, formats: list[str] | None = None) -> tuple[Trees, float]:
    """Trees, and the threshold from the documents that the trees haven't seen.

    Labels come from all documents and are counted by half, format and cell, so neither the order nor the split of the rows matters. The driver gets
    counts only, 2 * (formats) * CELLS of them at most.
    """
    counts = np.zeros((2, 2, CELLS))
    for r in labelled(docs, text, formats).groupBy("half", "label", "cell").agg(F.sum("n").alias("n")).collect():
        counts[r["half"], r["label"], r["cell"]] = r["n"]
    trees = Trees(counts[0, 1], counts[0, 0])
    return trees, trees.threshold(counts[1, 1], counts[1, 0])


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds email, ip, card, phone and extra (arrays of spans s, e) to every row of docs, under the names pii_email and so on.

    pii_extra holds candidates that the trees accept and that overlap no base span; without base matches to learn from there are none. Null and empty
    texts have no spans, an empty table gives an empty table, repeated rows get the same spans. Texts may have any length. Columns of docs keep
    their names, but for those with the name of an added one, which are replaced.
    """
    held = Sheltered(docs, {"_text": F.coalesce(F.col(f"`{text}`"), F.lit(""))})
    trees, least = fit(held.inside.select("_text"), "_text")
    found = candidates(base_spans(held.inside, "_text"), "_text")
    good = trees.accepted(least)
    accepted = F.from_json(F.lit(str(good)), "array<int>")
    found = found.withColumn("_extra", F.filter("_candidates", lambda c: F.array_contains(accepted, c["cell"]) if good else F.lit(False)))
    kinds = [*BASE, "extra"]
    return held.outside(computed(found.drop("_candidates", "_text"), [f"_{k}" for k in kinds]), {f"pii_{k}": f"_{k}" for k in kinds})


def redact(docs: DataFrame, text: str = "text", mark: str = "[redacted]") -> DataFrame:
    """docs with every span of personal data in the text replaced by mark; overlapping spans become one mark. Null texts stay null.

    Edge cases are those of ``find_pii``.
    """
    held = Sheltered(docs, {"_t": F.col(f"`{text}`")})
    found = find_pii(held.inside, "_t")
    kinds = [f"pii_{k}" for k in [*BASE, "extra"]]
    every = F.array_sort(F.concat(*[F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in kinds]))
    move = lambda at, x: F.greatest(at, x["e"])
    gap = lambda at, x: F.when(x["s"] >= at, F.concat(F.substring("_t", at + 1, x["s"] - at), F.lit(mark))).otherwise(F.lit(""))
    last = F.coalesce(F.array_max(F.transform(every, lambda x: x["e"])), F.lit(0))
    out = F.concat(F.array_join(scan(every, F.lit(0), move, gap, "string"), ""), F.substring("_t", last + 1, F.length("_t")))
    cut = computed(found.withColumn("_out", F.when(F.col("_t").isNotNull(), out)).drop("_t", *kinds), ["_out"])
    return held.outside(cut, {text: "_out"}).select(*[F.col(f"`{c}`") for c in docs.columns])


def _written(kind: str) -> Column:
    return F.transform(f"pii_{kind}", lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    written = {k: _written(k) for k in [*BASE, "extra"]}
    base = F.concat(*[written[k] for k in BASE])
    counts = [F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in [*BASE, "extra"]]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, written["extra"]), ",").alias("spans"))


QUERIES = {"op2_pii": op2_pii}
ORACLES: dict[str, str] = {}
