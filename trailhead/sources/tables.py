"""Sources: test tables, map extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailhead.sources import pbf


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


NODE = "_id long, _lat double, _lon double, tag array<struct<_k:string,_v:string>>"
WAY = "_id long, nd array<struct<_ref:long>>, tag array<struct<_k:string,_v:string>>"


def map_nodes(spark: SparkSession, path: str) -> DataFrame:
    """node, lat, lon, tags of a map extract: ``.pbf`` files, or else XML."""
    if path.endswith(".pbf"):
        return pbf.elements(spark, path).where("kind = 'node'").select(F.col("id").alias("node"), "lat", "lon", "tags")
    rows = spark.read.format("xml").option("rowTag", "node").schema(NODE).load(path)
    return rows.select(F.col("_id").alias("node"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), F.map_from_entries(F.coalesce("tag", F.array())).alias("tags"))


def map_ways(spark: SparkSession, path: str, nodes: DataFrame) -> DataFrame:
    """way, pos, node, lat, lon, tags; a way with a node that is not there, or has no place, is left out."""
    if path.endswith(".pbf"):
        rows = pbf.elements(spark, path).where("kind = 'way'").select(F.col("id").alias("way"), "tags", "refs")
    else:
        read = spark.read.format("xml").option("rowTag", "way").schema(WAY).load(path)
        rows = read.select(F.col("_id").alias("way"), F.map_from_entries(F.coalesce("tag", F.array())).alias("tags"), F.transform("nd", lambda x: x["_ref"]).alias("refs"))
    flat = rows.select("way", "tags", F.posexplode("refs").alias("pos", "node"))
    joined = flat.join(nodes.select("node", "lat", "lon"), "node", "left")
    whole = joined.groupBy("way").agg(F.count("*").alias("n"), F.count("lat").alias("m")).where("n = m").select("way")
    return joined.join(whole, "way", "left_semi")
