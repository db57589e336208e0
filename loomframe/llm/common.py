"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Regular-expression class of a word character in the contracts: anything but ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
#: A key with more than this share of a table's rows is dealt to several tasks; so there are at most as many such keys as its inverse.
HOT_SHARE = 1 / 1000
#: Keys with fewer rows than this aren't worth it.
HOT_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. The session names it on a cluster; only a local session gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Tables of one operator in a folder of its own, which goes when the operator has stored its result elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_dir(spark)}/work-{uuid.uuid4().hex}"

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, name, self.folder)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, space: Workspace | None = None) -> DataFrame:
    """df, stored, with a number for each row as the column _row: later jobs read the numbers, however they split the files."""
    return (space.stored if space else stored)(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def computed(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with columns computed once per row, below whatever filter follows.

    A filter on a projected column is pushed below the projection with the column's expression in its place; inside
    the lambdas of array functions that would evaluate it for every element. A generator of one row holds it back.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in rest], F.inline(F.array(F.struct(*columns))))


class Sheltered:
    """A table whose own columns are out of the way of an operator's: _own0, _own1, ... inside, their old names outside.

    ``inside`` has these and, for each name in ``use``, a copy under the operator's name for it.
    """

    def __init__(self, df: DataFrame, use: dict[str, Column]):
        self.names = df.columns
        self.own = [f"_own{i}" for i in range(len(self.names))]
        self.inside = df.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(self.names, self.own)], *[c.alias(n) for n, c in use.items()])

    def outside(self, df: DataFrame, add: dict[str, Column | str]) -> DataFrame:
        """df (made from inside) with the old columns under their names, and the added ones; an added name replaces an old one."""
        old = [F.col(o).alias(n) for n, o in zip(self.names, self.own) if n not in add]
        return df.select(*old, *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in add.items()])


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left joined with right, which has one row for each key at most; the rows of a hot key of left go to several tasks.

    Keys with more than HOT_SHARE of left's rows (1 / HOT_SHARE of them at most, which bounds what is broadcast) get salts; right's row
    of such a key is copied once for each salt. Both sides should be stored tables: they are read twice. Salts come from a hash of left's
    columns, so its rows should differ.
    """
    n = left.count()
    most = max(HOT_ROWS, int(n * HOT_SHARE))
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_salts"))
    hot = F.broadcast(hot)
    pick = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.col("_salts")).cast("int")).otherwise(0)
    a = left.join(hot, keys, "left").withColumn("_salt", pick).drop("_salts")
    b = right.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return a.join(b, [*keys, "_salt"], how).drop("_salt")


def placed(df: DataFrame, name: str) -> DataFrame:
    """df, stored, with the place of each row (task that stored it, and number in it) as the column _at."""
    return stored(df.withColumn("_at", F.monotonically_increasing_id()), name)


def row_numbers(rows: DataFrame, keys: list[str], out: str = "rank") -> DataFrame:
    """Adds to a table from ``placed`` a gapless number from 0 within keys, without gathering a key in one task.

    Rows are numbered inside (task that stored them, keys), and a task's offset comes from the counts of the tasks before it. The rows
    of a key and task are bounded by the size of a task; the counts are one row per key and task.
    """
    from pyspark.sql import Window as W

    tagged = rows.withColumn("_part", F.shiftright("_at", 33))
    counts = tagged.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = tagged.withColumn("_in", F.row_number().over(W.partitionBy("_part", *keys).orderBy("_at")) - 1)
    return inside.join(offsets, ["_part", *keys]).withColumn(out, (F.col("_in") + F.col("_before")).cast("long")).drop("_at", "_part", "_in", "_before")
