"""File sources: places, JSON lines, CSV, settings, artefacts that are kept while their inputs don't change, missing inputs.

Paths are anything that Spark's file systems open.  Nothing is read on the driver but small settings files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """The files of a folder whose names end in ``suffix``, in order; none if there is no such folder."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    found = (s.getPath() for s in fs.listStatus(p) if s.isFile())
    return sorted(f.toString() for f in found if f.getName().endswith(suffix))


def changed(spark: SparkSession, path: str) -> int:
    """When anything at ``path`` was last written (ms); -1 if it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return -1
    status = fs.getFileStatus(p)
    inside = [changed(spark, s.getPath().toString()) for s in fs.listStatus(p)] if status.isDirectory() else []
    return max([status.getModificationTime(), *inside])


def present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist."""
    return df.select([c for c in wanted if c in df.columns])


def places(spark: SparkSession, path: str, wanted: list[str], condition: Column | None = None) -> DataFrame:
    """Wanted columns of the Parquet files under ``path``; projection and condition reach the scan."""
    rows = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    return present(rows if condition is None else rows.where(condition), wanted)


def parquet_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one where nothing is there."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def of_cities(read: Callable[[str], DataFrame], paths: dict[str, str], spark: SparkSession) -> DataFrame | None:
    """Rows of every city whose file is there, with ``city``; cities without one are passed over, None if all are."""
    out = None
    for city, path in paths.items():
        if exists(spark, path):
            rows = read(path).withColumn("city", F.lit(city))
            out = rows if out is None else out.unionByName(rows)
    return out


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_lines_with(spark: SparkSession, path: str, schema: str, mark: str) -> DataFrame:
    """Rows of the lines that hold ``mark``; other lines are never parsed."""
    lines = spark.read.text(path).where(F.contains("value", F.lit(mark)))
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, by name of column, in the types of ``schema``; quotes are doubled within quotes, as usual."""
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    kinds = dict(spark.createDataFrame([], schema).dtypes)
    return rows.select(*[F.col(n).cast(kinds[n]).alias(n) if n in rows.columns else F.lit(None).cast(kinds[n]).alias(n) for n in names])


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, as a table that is filled row by row would keep it."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def settings(spark: SparkSession, path: str, defaults: dict[str, str] | None = None) -> dict[str, str]:
    """A small file of ``key=value`` lines, over ``defaults``; empty lines, comments and lines without a sign are passed over."""
    rows = spark.read.text(path).select(F.trim("value").alias("v")).where("v not like '#%' and contains(v, '=')") if exists(spark, path) else None
    found = rows.select(F.substring_index("v", "=", 1).alias("k"), F.expr("substring(v, instr(v, '=') + 1)").alias("x")).collect() if rows is not None else []
    return (defaults or {}) | {r["k"].strip(): r["x"].strip() for r in found}


def kept(spark: SparkSession, path: str, inputs: Iterable[str], build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; built and written anew if it is missing or older than one of its inputs."""
    if changed(spark, f"{path}/_SUCCESS") < max([0, *(changed(spark, p) for p in inputs)]):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def in_box(rows: DataFrame, box: tuple[float, float, float, float], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows in a box (south, north, west, east), bounds included."""
    south, north, west, east = box
    return rows.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def extent(rows: DataFrame, *by: str) -> DataFrame:
    """The box of rows (lat, lon), of each group where one is named."""
    return rows.groupBy(*by).agg(F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"))
