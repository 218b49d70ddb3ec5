"""Geo fixtures built from the test tables: vertices, edges, landmarks, areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailhead.operators import spatial
from trailhead.operators.walk import World
from trailhead.sources.tables import table

SQL = {
    "vertices": "select c_custkey as node, c_custkey {div} 40 as r, c_custkey % 40 as c, 6.58e0 + (c_custkey {div} 40) * 0.0009e0 as lat, -1.75e0 + (c_custkey % 40) * 0.0009e0 as lon from customer",
    "edges": """select src, dst, len_dm, name from (
        select src, dst, len_dm, name from (
          select c_custkey as src, c_custkey + 1 as dst, 800 + (c_custkey * 31) % 700 as len_dm, case when (c_custkey {div} 40) % 4 = 3 then '' else concat('Row Road ', c_custkey {div} 40) end as name
          from customer, (select count(*) as nc from customer) t where c_custkey % 40 < 39 and c_custkey + 1 < nc
          union all select c_custkey + 1, c_custkey, 800 + (c_custkey * 31) % 700, case when (c_custkey {div} 40) % 4 = 3 then '' else concat('Row Road ', c_custkey {div} 40) end
          from customer, (select count(*) as nc from customer) t where c_custkey % 40 < 39 and c_custkey + 1 < nc and (c_custkey {div} 40) % 5 <> 2
          union all select c_custkey, c_custkey + 40, 800 + (c_custkey * 17) % 700, case when c_custkey % 3 = 1 then '' else concat('Column Street ', c_custkey % 40) end
          from customer, (select count(*) as nc from customer) t where c_custkey + 40 < nc
          union all select c_custkey + 40, c_custkey, 800 + (c_custkey * 17) % 700, case when c_custkey % 3 = 1 then '' else concat('Column Street ', c_custkey % 40) end
          from customer, (select count(*) as nc from customer) t where c_custkey + 40 < nc) a) b where dst % 97 <> 96""",
    "landmarks": """select s_suppkey as id, concat(case s_suppkey % 8 when 0 then 'Market' when 1 then 'Hospital' when 2 then 'Church' when 3 then 'Bank' when 4 then 'School' when 5 then 'Hotel' when 6 then 'Eatery' else 'Stadium' end, ' ', s_suppkey % 301) as name,
        6.58e0 + (((s_suppkey * 7919) % nc) {div} 40) * 0.0009e0 + ((s_suppkey % 5) - 2) * 0.0001e0 as lat, -1.75e0 + (((s_suppkey * 7919) % nc) % 40) * 0.0009e0 + ((s_suppkey % 7) - 3) * 0.0001e0 as lon,
        case s_suppkey % 8 when 0 then 5 when 1 then 4 when 2 then 2 when 3 then 2 when 4 then 3 when 5 then 3 when 6 then 2 else 4 end as imp, (s_suppkey * 7919) % nc as node, case when s_suppkey % 3 = 0 then concat('NATION_', s_nationkey) else '' end as suburb from supplier, (select count(*) as nc from customer) t""",
    "areas": "select n_name as name, 6.58e0 + ((n_nationkey * (nc {div} 40)) {div} 25) * 0.0009e0 as lat, -1.75e0 + ((n_nationkey * 7) % 40) * 0.0009e0 as lon from nation, (select count(*) as nc from customer) t",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for t in ("customer", "supplier", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(SQL[name].format(div="div"))


def duck(name: str) -> str:
    return "(" + SQL[name].format(div="//") + ")"


def city(spark: SparkSession, sf_dir: str) -> tuple[World, DataFrame]:
    """The grid as a city, and its areas."""
    kind = F.when(F.abs(F.col("src") - F.col("dst")) == 1, "tertiary").otherwise("residential")
    edges = fixture(spark, sf_dir, "edges").select("src", "dst", (F.col("len_dm") / 10).alias("metres"), "name", kind.alias("kind"))
    areas, places = fixture(spark, sf_dir, "areas"), fixture(spark, sf_dir, "landmarks")
    near = spatial.nearest_of_few(places.select("id", "lat", "lon"), areas, "id")
    area = F.coalesce(F.nullif(F.col("suburb"), F.lit("")), F.col("area"))
    places = places.join(near, "id").select(F.concat(F.lit("grid_"), "id").alias("id"), "name", "lat", "lon", F.lower(F.split("name", " ")[0]).alias("cat"), "imp", area.alias("area"), "node", F.lit("osm").alias("source"))
    return World("grid", fixture(spark, sf_dir, "vertices").select("node", "lat", "lon"), edges, places), areas


SCENARIO = """id string, task string, city string, split string, pair array<string>,
  start struct<name:string,lat:double,lon:double,area:string,type:string,near:struct<name:string,type:string,dist_m:int,direction:string>>,
  end struct<name:string,lat:double,lon:double,area:string,type:string>, straight_km double, route_km double, original_km double, bearing string,
  steps array<struct<road:string,generic:boolean,heading:string,dist_m:int,start_node:bigint,end_node:bigint,turn:string,landmarks_at_end:array<string>,side_roads_passed:int,turn_ordinal:int,
    turn_lms:array<struct<name:string,type:string,side:string,dist_m:int,source:string>>>>,
  dest_side string, dest_near array<struct<name:string,type:string,dist_m:int,direction:string>>, avoid struct<kind:string,name:string>,
  nearby array<struct<name:string,type:string,dist_m:int,direction:string>>, variant string, question_landmark string, on_route boolean, on_road string, off_route_m int"""


def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scenario of two steps for each order; its facts follow from the order's number."""
    k = F.col("o_orderkey")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    way = F.get(F.array(*map(F.lit, ["left", "slight right", "straight"])), (k % 3).cast("int"))
    lms = F.when(k % 2 == 0, F.array(F.struct(text("Bank ", k % 7).alias("name"), F.lit("right").alias("side"))))
    steps = F.array(
        F.struct(text("Row Road ", k % 9).alias("road"), F.lit(False).alias("generic"), F.lit("north").alias("heading"), F.lit(None).cast("string").alias("turn"), (k % 4).cast("int").alias("side_roads_passed"), F.lit(None).cast("int").alias("turn_ordinal"), F.lit(None).cast(lms_type()).alias("turn_lms")),
        F.struct(F.lit("a side street").alias("road"), F.lit(True).alias("generic"), F.lit("east").alias("heading"), way.alias("turn"), F.lit(0).alias("side_roads_passed"), F.nullif(k % 4, F.lit(0)).cast("int").alias("turn_ordinal"), lms.alias("turn_lms")),
    )
    rows = table(spark, sf_dir, "orders").select(
        k.cast("string").alias("id"), F.when(k % 4 == 0, "avoid_road").otherwise("route").alias("task"), F.lit("Grid").alias("city"), F.when(k % 2 == 0, "test_pair").otherwise("test_area").alias("split"),
        F.struct(text("Market ", k % 11).alias("name"), F.lit("Adum").alias("area"), F.lit("market").alias("type")).alias("start"), F.struct(text("School ", k % 13).alias("name"), F.lit("Bantama").alias("area"), F.lit("school").alias("type")).alias("end"),
        steps.alias("steps"), F.when(k % 7 == 0, "ahead").otherwise("left").alias("dest_side"), F.when(k % 4 == 0, F.struct(F.lit("road").alias("kind"), F.lit("Ring Road").alias("name"))).alias("avoid"), F.lit("north-east").alias("bearing"),
    )
    return shaped(rows)


def lms_type() -> str:
    return "array<struct<name:string,side:string>>"


def shaped(rows: DataFrame) -> DataFrame:
    """Rows with every column of SCENARIO, in its types; what is missing is null."""
    schema = T.StructType.fromDDL(SCENARIO)

    def fit(c, have, want):
        if isinstance(want, T.StructType):
            fields = [fit(c[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType) for f in want]
            return F.when(c.isNotNull(), F.struct(*[x.alias(f.name) for x, f in zip(fields, want, strict=True)]))
        if isinstance(want, T.ArrayType) and isinstance(want.elementType, T.StructType):
            return F.transform(c, lambda x: fit(x, have.elementType, want.elementType))
        return c.cast(want)

    return rows.select(*[(fit(F.col(f.name), rows.schema[f.name].dataType, f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
