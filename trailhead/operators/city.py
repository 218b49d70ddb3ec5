"""Builds a city from a map extract and a table of places: drivable roads, landmarks at their nearest road, areas.

Everything is joined by node, way or name; only the strongly connected part and the acceptance of places see a city in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailhead.functions import scalar as S
from trailhead.operators import evaluation, landmarks, roads, spatial
from trailhead.operators.walk import DRIVEN, World
from trailhead.sources import files
from trailhead.sources.stages import settled

# Categories of places that outlast a stale entry, and the year before which an entry is stale.
LASTING = [
    "lorry park", "market", "mall", "hospital", "stadium", "supermarket", "hotel", "school", "police station", "post office", "monument", "park", "bank", "filling station", "church", "mosque",
]
STALE_BEFORE = 2016
# Fixed value: metres within which a landmark must have a road.
REACH = 250.0


def tag(name: str) -> Column:
    return F.nullif(F.col("tags")[name], F.lit(""))


def road_name() -> Column:
    """A way's name, else its number, else nothing."""
    return F.coalesce(tag("name"), tag("ref"), F.lit(""))


def drivable(ways: DataFrame) -> DataFrame:
    """Nodes of ways (way, pos, node, lat, lon, tags) that are roads to drive on."""
    return ways.where(F.col("tags")["highway"].isin(DRIVEN))


def edges(ways: DataFrame) -> DataFrame:
    """src, dst, metres, name, kind of the drivable ways, both ways unless one-way."""
    driven = drivable(ways)
    each = driven.groupBy("way").agg(F.first("tags").alias("tags")).select("way", road_name().alias("name"), F.col("tags")["highway"].alias("kind"), F.coalesce(F.col("tags")["oneway"] == "yes", F.lit(False)).alias("oneway"))
    pieces = roads.edges_of_ways(driven.select("way", "pos", "node", "lat", "lon")).join(each, "way")
    return roads.both_ways(pieces, "metres", "name", "kind")


def centroids(way_nodes: DataFrame) -> DataFrame:
    """way, lat, lon: the mean of a way's nodes; a closing node counts twice."""
    return way_nodes.groupBy("way").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def named_things(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """name, lat, lon, cat, imp, suburb, pos: named nodes, ways that are no roads (at their centroid) and roundabouts (at their first node)."""
    kind = landmarks.tag_category(F.col("tags"))
    out = lambda pos, cat, imp, suburb: ("name", "lat", "lon", cat.alias("cat"), imp.alias("imp"), suburb.alias("suburb"), pos.alias("pos"))
    suburb = F.coalesce(F.col("tags")["addr:suburb"], F.lit(""))
    named = nodes.withColumns({"name": tag("name"), "k": kind}).where("name is not null and k is not null")
    points = named.select(*out(F.struct(F.lit(0).alias("source"), F.col("node").alias("id")), F.col("k.cat"), F.col("k.imp"), suburb))
    way = F.struct(F.lit(1).alias("source"), F.col("way").alias("id"))
    each = ways.groupBy("way").agg(F.first("tags").alias("tags"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.min_by(F.struct("lat", "lon"), "pos").alias("first"))
    each = each.withColumns({"name": tag("name"), "k": kind, "road": F.coalesce(F.col("tags")["highway"].isin(DRIVEN), F.lit(False))}).where("name is not null")
    shapes = each.where("not road and k is not null").select(*out(way, F.col("k.cat"), F.col("k.imp"), suburb))
    rounds = each.where("road and tags['junction'] = 'roundabout'").withColumns({"lat": F.col("first.lat"), "lon": F.col("first.lon")})
    return points.unionByName(shapes).unionByName(rounds.select(*out(way, F.lit("roundabout"), F.lit(4), F.lit(""))))


def at_roads(things: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """Things (key, lat, lon, ...) with the nearest road ``node``; those without one within REACH are left out."""
    near = spatial.nearest(things.select(key, "lat", "lon"), nodes.select("node", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")), key, "node", REACH)
    return things.join(near.select(key, "node"), key)


def names_other_city(name: Column, city: Column, cities: list[str]) -> Column:
    """Whether a name holds, as a word, one of ``cities`` other than its own."""
    others = F.array_except(F.array(*map(F.lit, cities)), F.array(F.lower(city)))
    return F.exists(others, lambda o: F.regexp_like(F.lower(name), F.concat(F.lit(r"(?U)\b"), o, F.lit(r"\b"))))


def usable_places(places: DataFrame, box: tuple[float, float, float, float], city: str, cities: list[str]) -> DataFrame:
    """id, name, lat, lon, cat, imp of open places (fsq_place_id, name, latitude, longitude, fsq_category_labels, date_closed, date_refreshed)
    in a box that have a category, a landmark's name, no other city's name in it, and are not stale."""
    rows = files.in_box(places.where("date_closed is null and name is not null"), box, "latitude", "longitude")
    rows = rows.select(F.col("fsq_place_id").alias("id"), S.squash(F.col("name")).alias("name"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), landmarks.classify(F.col("fsq_category_labels")).alias("k"), S.first_year(F.col("date_refreshed").cast("string")).alias("year"))
    rows = rows.where(F.col("k").isNotNull() & landmarks.kept_name(F.col("name")) & ~names_other_city(F.col("name"), F.lit(city), cities))
    return rows.where((F.col("year") >= STALE_BEFORE) | F.col("k.cat").isin(LASTING)).select("id", "name", "lat", "lon", "k.cat", "k.imp")


def added_places(usable: DataFrame, known: DataFrame, nodes: DataFrame, city: str) -> DataFrame:
    """The usable places that are new: not on the map under a like name, no repeat of each other, at a road, no name taken."""
    new = evaluation.not_on_map(usable, known.where("cat <> 'area'"))
    kept = evaluation.accept_in_order(new.withColumn("city", F.lit(city)), "id")
    reached = at_roads(kept, nodes, "id").withColumn("low", F.lower("name"))
    free = reached.join(known.select(F.lower("name").alias("low")).distinct(), "low", "left_anti")
    return files.first_per_key(free, "low", "id").drop("low")


def build(city: str, nodes: DataFrame, ways: DataFrame, places: DataFrame | None = None, cities: list[str] | None = None) -> tuple[World, DataFrame]:
    """A World and its areas, of map nodes (node, lat, lon, tags), ways (way, pos, node, lat, lon, tags) and, if given, places."""
    every = settled(edges(ways))
    part = settled(roads.largest_strong_part(every.select("src", "dst")))
    inside = lambda end: part.withColumnRenamed("node", end)
    own = settled(every.join(inside("src"), "src", "left_semi").join(inside("dst"), "dst", "left_semi"))
    where = settled(ways.groupBy("node").agg(F.first("lat").alias("lat"), F.first("lon").alias("lon")).join(part, "node", "left_semi"))
    best = landmarks.best_by_name(named_things(nodes, ways).withColumn("name", F.trim("name")), "pos")
    numbered = best.withColumn("nth", F.row_number().over(Window.partitionBy(F.lit(city)).orderBy("first_pos")) - 1)
    rounded = [F.round(c, 5).alias(c) for c in ("lat", "lon")]
    found = at_roads(numbered, where, "nth").select(F.concat(F.lit(f"{city}_"), F.col("nth").cast("string")).alias("id"), "name", *rounded, "cat", "imp", "node", "suburb", F.lit("osm").alias("source"))
    found = settled(found)
    if places is not None:
        box = files.extent(where).first()
        new = added_places(usable_places(places, (box["south"], box["north"], box["west"], box["east"]), city, cities or []), found, where, city)
        nth = F.row_number().over(Window.partitionBy(F.lit(city)).orderBy("id")) - 1 + found.count()
        more = new.withColumn("nth", nth).select(F.concat(F.lit(f"{city}_f"), F.col("nth").cast("string")).alias("id"), "name", *rounded, "cat", "imp", "node", F.lit("").alias("suburb"), F.lit("foursquare").alias("source"))
        found = settled(found.unionByName(more))
    areas = found.where("cat = 'area'").select("name", "lat", "lon")
    near = spatial.nearest_of_few(found.select("id", "lat", "lon"), areas, "id")
    area = F.when(F.col("cat") == "area", F.col("name")).otherwise(F.coalesce(F.nullif(F.col("suburb"), F.lit("")), "area", F.lit("")))
    whole = found.join(near, "id", "left").withColumn("area", area)
    return World(city, where, own, settled(whole.select("id", "name", "lat", "lon", "cat", "imp", "area", "node", "suburb", "source"))), areas


def save(world: World, path: str) -> None:
    """A city's three tables as Parquet, to be loaded instead of built."""
    for name in ("nodes", "edges", "landmarks"):
        getattr(world, name).write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark, city: str, path: str) -> World:
    return World(city, *[spark.read.parquet(f"{path}/{name}") for name in ("nodes", "edges", "landmarks")])
