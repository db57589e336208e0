"""Scalar functions as column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed unit vectors of the phase-encoding directions.
DIRECTIONS = {"i": (1, 0, 0), "i-": (-1, 0, 0), "j": (0, 1, 0), "j-": (0, -1, 0), "k": (0, 0, 1), "k-": (0, 0, -1)}


def component_id(s: Column) -> Column:
    """F1. Trailing digits; an error without any."""
    n = F.regexp_extract(s, r"(\d+)$", 1)
    return F.when(n != "", n.cast("int")).otherwise(F.raise_error(F.concat(F.lit("no component number in "), s)).cast("int"))


def manual_id(name: Column) -> Column:
    """F2. Number after comp or ica, null without one."""
    return F.expr("try_cast(nullif(regexp_extract({}, '(?i)(?:comp|ica)[_-]?([0-9]+)', 1), '') AS INT)".format(_name(name)))


def _name(c: Column) -> str:
    return c._jc.toString() if hasattr(c, "_jc") else str(c)


def parse_entities(name: Column) -> tuple[Column, Column]:
    """F3. (map of key-value parts, suffix) of a file name; only the first dash of a part separates, and of a repeated entity the last one wins."""
    parts = F.split(F.regexp_replace(name, r"\.nii\.gz$", ""), "_")
    pairs = F.filter(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.contains("-"))
    entry = F.transform(pairs, lambda p: F.struct(F.substring_index(p, "-", 1).alias("key"), F.substring(p, F.instr(p, "-") + 1, F.length(p)).alias("value")))
    last = F.filter(entry, lambda e, i: ~F.exists(F.slice(entry, i + 2, F.greatest(F.size(entry) - i - 1, F.lit(0))), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last), F.element_at(parts, -1)


def run_group_key(name: Column) -> Column:
    """F4. run-x if there is one, else the name without echo and suffix."""
    run = F.regexp_extract(name, r"(?:^|_)(run-[^_]+)", 1)
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"\.nii\.gz$", ""), r"_echo-[^_]+", ""), r"_[^_]*$", "")
    return F.when(run != "", run).otherwise(rest)


def series_number(value: str, name: str) -> Column:
    """F5. An integer, a digit string, else the number after s or series in the file name (columns by name)."""
    return F.expr(f"coalesce(try_cast({value} AS INT), try_cast(nullif(regexp_extract({name}, '(?i)(?:series|s)[-_]?([0-9]+)', 1), '') AS INT))")


def numeric_echo(name: str) -> Column:
    """F6. Digits only, else null."""
    return F.expr(f"CASE WHEN {name} RLIKE '^[0-9]+$' THEN try_cast({name} AS INT) END")


def pe_to_vector(d: Column) -> Column:
    """F7. Signed unit vector, null for anything else."""
    out = None
    for k, v in DIRECTIONS.items():
        a = F.array(*[F.lit(x) for x in v])
        out = F.when(d == k, a) if out is None else out.when(d == k, a)
    return out


def pe_to_axis(d: Column) -> Column:
    """F8."""
    return F.when(d == "j-", "-y").otherwise("y")


def te_units(te: Column, target: str = "s") -> Column:
    """F9. Echo times in seconds or milliseconds: any value above 1 means milliseconds. Null unless strictly ascending."""
    is_ms = F.exists(te, lambda t: t > 1)
    scale = F.when(is_ms, 0.001 if target == "s" else 1.0).otherwise(1.0 if target == "s" else 1000.0)
    rising = F.forall(F.zip_with(F.slice(te, 1, F.size(te) - 1), F.slice(te, 2, F.size(te)), lambda a, b: a < b), lambda x: x)
    return F.when(rising, F.transform(te, lambda t: t * scale))


def format_g(x: Column, digits: int = 5) -> Column:
    """F10. Significant digits, trailing zeros dropped, exponents outside 1e-4..10^digits."""
    wanted = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(x))))
    fixed = F.round(x * wanted) / wanted
    exponent = F.floor(F.log10(F.abs(fixed)) + 1e-12)  # rounding may have added a digit
    text = F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits + 4}f", fixed), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    wide = F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits - 1}e", x), r"(\.[0-9]*?)0+e", "$1e"), r"\.e", "e")
    return F.when(x == 0, "0").when((exponent < -4) | (exponent >= digits), wide).otherwise(text)


def expand_range(expression: str) -> list[float]:
    """F11. A comma list or start:step:stop, the stop included within a thousandth of a step."""
    out: list[float] = []
    for part in filter(None, (p.strip() for p in expression.split(","))):
        if ":" not in part:
            out.append(float(part))
            continue
        start, step, stop = map(float, part.split(":"))
        if step == 0:
            raise ValueError("the step is zero")
        n = math.floor((stop - start) / step + 1e-3)
        out += [start + k * step for k in range(n + 1)]
    return out


def fisher_z(r: Column) -> Column:
    """F12."""
    return F.atanh(r)


def log_ratio(k: Column, r: Column, eps: float = 1e-8) -> Column:
    """F13."""
    return F.log10(k / F.greatest(r, F.lit(eps)) + eps)


def clip(x: Column, low: float, high: float) -> Column:
    """F14."""
    return F.greatest(F.lit(low), F.least(x, F.lit(high)))


def softmax(scores: DataFrame, keys: list[str], col: str = "score") -> DataFrame:
    """F15. p within keys, shifted by the largest score."""
    w = Window.partitionBy(*keys)
    e = scores.withColumn("_e", F.exp(F.col(col) - F.max(col).over(w)))
    return e.withColumn("p", F.col("_e") / F.greatest(F.sum("_e").over(w), F.lit(1e-8))).drop("_e")


def sigma_from_fwhm(f: Column) -> Column:
    """F16."""
    return f / (2 * math.sqrt(2 * math.log(2)))


def _log_sf(t: np.ndarray, dof: float) -> np.ndarray:
    """Log of the upper tail of Student's t, t >= 0: continued fraction of the incomplete beta function (Lentz)."""
    x = dof / (dof + t * t)
    a, b = dof / 2, 0.5
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for num in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / np.where(np.abs(c) < tiny, tiny, c)
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            h = h * d * c
    lead = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    with np.errstate(divide="ignore"):
        log_i = lead + p * np.log(y) + q * np.log1p(-y) + np.log(h) - np.log(p)
        log_i = np.where(swap, np.log1p(-np.minimum(np.exp(log_i), 1.0)), log_i)
    return log_i - math.log(2)


def _normal_from_log_sf(log_p: np.ndarray) -> np.ndarray:
    """z >= 0 with upper tail exp(log_p): Newton steps on the log of the tail."""
    z = np.sqrt(np.maximum(0.0, -2 * log_p - np.log(np.maximum(2 * math.pi * np.maximum(-2 * log_p, 1e-9), 1.0))))
    for _ in range(60):
        f = np.array([math.log(math.erfc(v / math.sqrt(2)) / 2) if v < 35 else -v * v / 2 - math.log(v * math.sqrt(2 * math.pi)) - 1 / (v * v) for v in z])
        slope = np.exp(-z * z / 2 - 0.5 * math.log(2 * math.pi) - f)
        z = np.maximum(0.0, z + (f - log_p) / np.maximum(slope, 1e-12))
    return z


def t_to_z(t: Column, dof: float, cap: float = 38.5) -> Column:
    """F17. The normal quantile of equal tail, sign kept, capped; NaN and null become 0. Arrow batches, numpy only."""

    @F.pandas_udf("double")
    def convert(v: pd.Series) -> pd.Series:
        x = v.fillna(0.0).to_numpy(float)
        z = _normal_from_log_sf(_log_sf(np.minimum(np.abs(x), 1e8), dof)) if len(x) else x
        return pd.Series(np.clip(np.sign(x) * z, -cap, cap))

    return convert(t)


def json_get(body: Column, key: str, default: Column) -> Column:
    """F18. Optional key of a JSON object."""
    return F.coalesce(F.get_json_object(body, f"$.{key}"), default)


def fill_non_finite(x: Column, v: float = 0.0) -> Column:
    """F19. Null, NaN and infinities become v."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(v)).otherwise(x)


def rescale01(df: DataFrame, col: str) -> DataFrame:
    """F20. (x - min) / (max - min + 1e-8)."""
    c = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return df.crossJoin(F.broadcast(c)).withColumn(col, (F.col(col) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1e-8)).drop("_lo", "_hi")


def euclidean(a: list[Column], b: list[Column]) -> Column:
    """F21."""
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b)), F.lit(0.0)))


def affine_coords(ijk: list[Column], affine: list[list[float]]) -> list[Column]:
    """F22. Coordinates in mm of a voxel index."""
    return [sum((F.lit(float(m)) * x for m, x in zip(row[:3], ijk)), F.lit(0.0)) + float(row[3]) for row in affine[:3]]


def rotate_vectors(b: list[Column], m: list[list[float]]) -> list[Column]:
    """F23."""
    return affine_coords(b, [[*row[:3], 0.0] for row in m])
