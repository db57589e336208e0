"""Readers of run tables, sidecars, component tables, text matrices and id lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed column names that producers of component tables use, and the name here.
COMPONENT_NAMES = {"Component": "component", "kappa": "kappa", "rho": "rho", "classification": "classification", "variance explained": "variance_explained", "countsigFT2": "n_voxels"}
#: Fixed names of the older layout.
OLD_COMPONENT_NAMES = {"Kappa": "kappa", "Rho": "rho", "Classification": "classification"}


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN marks what is unknown in files; here that is null."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def read_signal(spark: SparkSession, path: str, runs: list[int] | None = None) -> DataFrame:
    """S1. run, node_id, frame, value; every run must have the same number of nodes."""
    out = nan_to_null(require_columns(spark.read.parquet(path), ["run", "node_id", "frame", "value"]))
    if runs is not None:
        out = out.filter(F.col("run").isin(runs))
    n = out.groupBy("run").agg(F.countDistinct("node_id").alias("n")).agg(F.min("n").alias("a"), F.max("n").alias("b")).first()
    if n["a"] != n["b"]:
        raise ValueError(f"runs differ in their nodes: {n['a']} and {n['b']}")
    return out


def list_runs(spark: SparkSession, root: str, start_session: int = 1) -> DataFrame:
    """S2. path, length, session, run of the files below session_N/run_N, from start_session on. File contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return runs_of_paths(files, start_session)


def runs_of_paths(files: DataFrame, start_session: int = 1) -> DataFrame:
    number = lambda kind: F.regexp_extract("path", f"{kind}_([0-9]+)/", 1)
    found = files.withColumns({"session": number("session"), "run": number("run")}).filter("session <> '' AND run <> ''")
    return found.withColumns({"session": F.col("session").cast("int"), "run": F.col("run").cast("int")}).filter(F.col("session") >= start_session)


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """S3. path, body and typed fields of one JSON object per file; a file that isn't one is an error."""
    return parse_sidecars(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")))


def parse_sidecars(sidecars: DataFrame) -> DataFrame:
    schema = "EchoTime double, RepetitionTime double, EffectiveEchoSpacing double, SliceTiming array<double>, PhaseEncodingDirection string"
    s = F.from_json("body", schema)
    checked = F.when(F.expr("try_parse_json(body)").isNull(), F.raise_error(F.concat(F.lit("not JSON: "), F.col("path").cast("string")))).otherwise(F.col("body"))
    out = sidecars.withColumn("body", checked).withColumn("_s", s)
    return out.select("path", "body", F.col("_s.EchoTime").alias("echo_time"), F.coalesce("_s.RepetitionTime", F.lit(2.0)).alias("tr"), F.col("_s.EffectiveEchoSpacing").alias("spacing"), F.col("_s.SliceTiming").alias("slice_timing"), F.coalesce("_s.PhaseEncodingDirection", F.lit("j-")).alias("pe_direction"))


def read_components(spark: SparkSession, path: str) -> DataFrame:
    """S4. Component tables, columns renamed, component_id from the trailing digits, in its order: TSV with a header (of the current or of the older
    names), or a JSON object with an entry for each component."""
    if path.endswith(".json"):
        return parse_components(spark.read.text(path, wholetext=True).select(F.col("value").alias("body")))
    return name_components(spark.read.csv(path, sep="\t", header=True))


def name_components(raw: DataFrame) -> DataFrame:
    old = {k: v for k, v in OLD_COMPONENT_NAMES.items() if k in raw.columns and v not in raw.columns}
    out = raw.withColumnsRenamed({k: v for k, v in COMPONENT_NAMES.items() if k in raw.columns} | old)
    require_columns(out, ["component", "kappa", "rho", "classification"])
    number = F.regexp_extract("component", r"(\d+)$", 1)
    checked = F.when(number != "", number.cast("int")).otherwise(F.raise_error(F.concat(F.lit("no component number in "), F.col("component"))).cast("int"))
    return out.withColumns({"component_id": checked, "kappa": F.col("kappa").cast("double"), "rho": F.col("rho").cast("double")}).orderBy("component_id")


def parse_components(bodies: DataFrame) -> DataFrame:
    """Components of JSON objects (body): keys that begin with ica_ and end in a number, with their metrics."""
    entry = "map<string,struct<classification:string,kappa:double,rho:double,`variance explained`:double,`normalized variance explained`:double>>"
    # other keys of the object hold anything; only those of components are read as one
    keys = F.filter(F.json_object_keys("body"), lambda k: k.rlike(r"^ica_.*[0-9]$"))
    rows = bodies.select("body", F.explode(keys).alias("component"))
    one = F.from_json(F.expr("to_json(variant_get(parse_json(body), concat('$[\"', component, '\"]'), 'variant'))"), entry[len("map<string,") : -1])
    named = rows.select("component", one.alias("e")).select("component", "e.classification", "e.kappa", "e.rho", F.col("e.`variance explained`").alias("variance_explained"), F.col("e.`normalized variance explained`").alias("normalised_variance"))
    return name_components(named)


def read_matrix_text(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """S5. frame, p1..pn of white-space separated numbers, a line for each frame; another number of columns is an error."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", r"\s+$", ""), "\n")).alias("frame", "line"))
    return parse_matrix(lines, columns)


def parse_matrix(lines: DataFrame, columns: int) -> DataFrame:
    parts = F.split(F.trim("line"), r"\s+")
    checked = F.when(F.size(parts) == columns, parts).otherwise(F.raise_error(F.lit(f"a line hasn't {columns} columns")).cast("array<string>"))
    return lines.withColumn("_p", checked).select("frame", *[F.col("_p")[i].cast("double").alias(f"p{i + 1}") for i in range(columns)])


def read_keep(spark: SparkSession, path: str, keep_value: float = 1.0) -> DataFrame:
    """S6. frame, keep: one number per frame."""
    text = spark.read.text(path, wholetext=True)
    return parse_keep(text.select(F.lit(0).alias("run"), F.col("value").alias("text")), keep_value).drop("run")


def parse_keep(texts: DataFrame, keep_value: float = 1.0) -> DataFrame:
    numbers = F.filter(F.split("text", r"[\s,]+"), lambda x: x != "")
    return texts.select("run", F.posexplode(numbers).alias("frame", "_v")).select("run", "frame", (F.col("_v").cast("double") == keep_value).alias("keep"))


def read_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """S7. Edges whose two ends are among the nodes."""
    n = nodes.select("node_id").distinct()
    return edges.join(n.withColumnRenamed("node_id", "src"), "src", "left_semi").join(n.withColumnRenamed("node_id", "dst"), "dst", "left_semi")


def parse_label_lut(texts: DataFrame) -> DataFrame:
    """S8. label_id, name, r, g, b, a of two-line records: the name, then five numbers."""
    lines = texts.select(F.posexplode(F.split(F.regexp_replace("text", r"\s+$", ""), "\n")).alias("pos", "line"))
    pairs = lines.groupBy(F.floor(F.col("pos") / 2).alias("k")).agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("line"))).alias("name"), F.max(F.when(F.col("pos") % 2 == 1, F.split(F.trim("line"), r"\s+"))).alias("n"))
    number = lambda i: F.col("n")[i].cast("int")
    return pairs.select(number(0).alias("label_id"), "name", *[number(i + 1).alias(c) for i, c in enumerate("rgba")])


def parse_filecount(lines: DataFrame, col: str = "line") -> DataFrame:
    """S9. series, n_images of lines ``n, ..., S<series>,``."""
    pattern = r"^\s*(\d+),.*,\s*S(\d+),"
    hit = lines.filter(F.col(col).rlike(pattern))
    return hit.select(F.regexp_extract(col, pattern, 2).cast("int").alias("series"), F.regexp_extract(col, pattern, 1).cast("int").alias("n_images"))


def run_metadata(spark: SparkSession, settings: dict[str, object]) -> DataFrame:
    """S14. key, value of the effective settings."""
    return spark.createDataFrame([(k, str(v)) for k, v in sorted(settings.items())], "key string, value string")


