"""URL filtering by host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import Sheltered, stored, table

#: Fixed values of the op3 contract: (host, path, verdict).
CONTRACT_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Bits of the digest that the join compares first.
SHORT_BITS = 32


def split_url(url: str) -> tuple[Column, Column]:
    """(host, path) of a column of urls: empty for a null url and for one without ``://``."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    authority = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(authority, upper, lower), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, SHORT_BITS // 4), 16, 10).cast("long")


def url_filter(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to every row of pages.

    rules has host, path and verdict; a rule fits its host and all subdomains when the path starts with its path. Of
    the fitting rules the one with the most characters wins, then the longer host, then ``block``. Rows without a fitting rule get
    ``default`` and a null rule. Null urls and urls without ``://`` have empty host and path; repeated rows stay
    repeated; an empty table (or no rules) gives what it must; urls may have any length. Columns of pages keep their names, whatever these
    are, but host, path, rule and verdict are replaced.

    Each *distinct* (host, path) is expanded into the (host suffix, path prefix) expressions of the shapes
    (labels, path length) that occur among the rules, so the expansion is bounded by the number of different shapes
    and not by the url. Expressions meet the rules in an equi-join on a short digest prefix; the full digest confirms. The verdicts of
    distinct urls are stored before they meet the pages again, so that the join can split a url that many pages have.
    """
    held = Sheltered(pages, {"_url": F.col(f"`{url}`")})
    host, path = split_url("_url")
    split = held.inside.withColumns({"_host": host, "_path": path}).drop("_url")
    ranked = F.struct(F.length(F.concat("host", "path")).alias("n"), F.length("host").alias("h"), (F.col("verdict") == "block").alias("b"), F.concat("host", "path").alias("rule"), "verdict")
    known = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull()).withColumns({"full": _digest(F.col("host"), F.col("path")), "best": ranked})
    known = known.groupBy("full").agg(F.max("best").alias("best")).withColumn("short", _short(F.col("full")))
    shapes = [list(r) for r in rules.select(F.size(F.split("host", "\\.")).alias("n"), F.length("path").alias("m")).dropna().distinct().orderBy("n", "m").collect()]
    labels = F.split("_host", "\\.")
    every = F.from_json(F.lit(str(shapes)), "array<array<int>>")
    fits = F.filter(every, lambda x: (F.size("_labels") >= x[0]) & (F.length("_path") >= x[1]))
    form = F.transform(fits, lambda x: F.struct(F.array_join(F.slice("_labels", F.size("_labels") - x[0] + 1, x[0]), ".").alias("h"), F.substring(F.col("_path"), F.lit(1), x[1]).alias("p")))
    seen = split.select("_host", "_path").distinct().withColumn("_labels", labels)
    expanded = seen.select("_host", "_path", F.explode(form).alias("e")).withColumn("full", _digest(F.col("e.h"), F.col("e.p"))).withColumn("short", _short(F.col("full"))).drop("e")
    hit = expanded.alias("x").join(known.alias("k"), (F.col("x.short") == F.col("k.short")) & (F.col("x.full") == F.col("k.full")))
    judged = stored(hit.groupBy(F.col("x._host").alias("_host"), F.col("x._path").alias("_path")).agg(F.max("k.best").alias("_best")), "verdicts")
    return held.outside(split.join(judged, ["_host", "_path"], "left"), {"host": "_host", "path": "_path", "rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))})


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(CONTRACT_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in CONTRACT_RULES)
ORACLE = f"""
WITH rules(rh, rp, rv) AS (VALUES {_RULE_ROWS}),
u AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT n, rh || rp AS rule, rv, row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC) AS k
      FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM h LEFT JOIN (SELECT * FROM f WHERE k = 1) USING (n)
"""
QUERIES = {"op3_url_filter": op3_url_filter}
ORACLES = {"op3_url_filter": ORACLE}
