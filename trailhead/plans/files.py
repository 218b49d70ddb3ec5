"""Queries that write and read files, or read a map extract, with SQL over the tables that the files were made from."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailhead.functions import scalar as S
from trailhead.operators import city as cities
from trailhead.operators import landmarks, roads
from trailhead.plans.fixtures import city, duck, fixture
from trailhead.plans.queries import PIECES, V, query, way_nodes
from trailhead.sources import files, sinks
from trailhead.sources.stages import new_path
from trailhead.sources.tables import map_nodes, map_ways, table
from trailhead.streaming import incremental

L = duck("landmarks")


@query("select o_orderkey, o_orderstatus as split, o_orderpriority as task from orders where o_orderstatus <> 'P'")
def parquet_by_split(spark, d):
    """Release folders: what stood there is replaced, one folder for each split, zstd."""
    path = sinks.replaced(spark, new_path(spark, "release"))
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("split"), F.col("o_orderpriority").alias("task"))
    sinks.by_split(rows.limit(0), f"{path}/directions")
    sinks.by_split(rows, f"{path}/directions", rows_per_file=5000)
    assert all(".zstd." in f for s in ("F", "O") for f in files.listed(spark, f"{path}/directions/split={s}", ".parquet"))
    return files.places(spark, f"{path}/directions", ["o_orderkey", "split", "task", "not_there"], F.col("split") != "P")


@query("select s_suppkey as id, concat('A \"', s_name, '\", or', chr(10), 'so') as name, s_acctbal as lat, s_nationkey::int as imp, null::varchar as missing from supplier")
def csv_round_trip(spark, d):
    path = new_path(spark, "csv")
    name = F.concat(F.lit('A "'), "s_name", F.lit('", or\nso'))
    sinks.csv(table(spark, d, "supplier").select("s_nationkey", F.col("s_suppkey").alias("id"), name.alias("name"), F.col("s_acctbal").alias("lat"), F.col("s_nationkey").alias("imp")), path)
    return files.csv_rows(spark, path, "id long, name string, lat double, imp int, missing string")


PAIR = "select o_orderkey::varchar as id, case when o_orderkey % 3 = 0 then 'route' else 'nearby' end as task, case when o_orderkey % 5 = 0 then null else concat('Wo ist „', o_orderpriority, '“?') end as input from orders"


def _pairs(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 5 != 0, F.concat(F.lit("Wo ist „"), "o_orderpriority", F.lit("“?")))
    return table(spark, d, "orders").select(k.cast("string").alias("id"), F.when(k % 3 == 0, "route").otherwise("nearby").alias("task"), text.alias("input"))


@query(PAIR)
def json_lines_round_trip(spark, d):
    path = new_path(spark, "json")
    sinks.json_lines(_pairs(spark, d), path)
    return files.json_lines(spark, path, "id string, task string, input string")


@query(f"select * from ({PAIR}) where task = 'route'")
def json_lines_with_mark(spark, d):
    path = new_path(spark, "json")
    sinks.json_lines(_pairs(spark, d), path)
    return files.json_lines_with(spark, path, "id string, task string, input string", '"task":"route"')


@query("select l_orderkey, l_linenumber, l_suppkey from (select *, row_number() over (partition by l_orderkey order by l_linenumber desc, l_partkey desc, l_suppkey desc) as n from lineitem) where n = 1")
def last_per_key(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("at"))
    return files.last_per_key(rows, "l_orderkey", "at").drop("at")


@query("select l_orderkey, l_linenumber, l_suppkey from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as n from lineitem) where n = 1")
def first_row_per_key(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("at"))
    return files.first_per_key(rows, "l_orderkey", "at").drop("at")


@query("select c_custkey as id, 'a' as city from customer where c_custkey % 2 = 0 union all select c_custkey, 'b' from customer where c_custkey % 3 = 0")
def cities_present(spark, d):
    """Cities whose files are there, and a table that is not."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    paths = {c: new_path(spark, f"city-{c}") for c in "abc"}
    for c, n in (("a", 2), ("b", 3)):
        sinks.json_lines(rows.where(F.col("id") % n == 0), paths[c])
    found = files.of_cities(lambda p: files.json_lines(spark, p, "id long"), paths, spark)
    return found.unionByName(files.parquet_or_empty(spark, paths["c"], "id long, city string"))


@query("select n_nationkey, n_name, 1 as built from nation")
def kept_artifact(spark, d):
    """Built once, then read; built anew only when the input is newer."""
    source, path, built = new_path(spark, "in"), new_path(spark, "kept"), []
    table(spark, d, "nation").write.parquet(source)

    def build():
        built.append(1)
        return spark.read.parquet(source)

    for _ in range(3):
        rows = files.kept(spark, path, [source], build)
    return rows.select("n_nationkey", "n_name", F.lit(len(built)).alias("built"))


@query("select k, v from (values ('MODEL', 'a=b'), ('LIMIT', '5'), ('CITY', 'accra')) as t(k, v)")
def settings_lines(spark, d):
    path = new_path(spark, "env")
    spark.createDataFrame([("MODEL=a=b",), ("# KEY=x",), ("",), ("no sign",), (" LIMIT = 5 ",)], "value string").coalesce(1).write.text(path)
    found = files.settings(spark, path, {"CITY": "accra", "LIMIT": "9"})
    assert files.settings(spark, path + "-gone", {"CITY": "x"}) == {"CITY": "x"}
    return spark.createDataFrame(sorted(found.items()), "k string, v string")


@query(f"select node, lat, lon from {V} where lat between 6.5818 and 6.6007 and lon between -1.7455 and -1.7293")
def box_extract(spark, d):
    return files.in_box(fixture(spark, d, "vertices").select("node", "lat", "lon"), (6.5818, 6.6007, -1.7455, -1.7293))


@query(f"select id % 3 as city, min(lat) as south, max(lat) as north, min(lon) as west, max(lon) as east from {L} group by 1")
def extents(spark, d):
    return files.extent(fixture(spark, d, "landmarks").withColumn("city", F.col("id") % 3), "city")


@query("select o_orderkey::varchar as id, case when o_orderkey % 4 = 0 then 'side' end as reason from orders where o_orderkey % 4 = 0 or o_orderkey % 4 > 1")
def accepted_and_rejected(spark, d):
    """Two appends to two outputs, of which a later run needs the ids only."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 4 == 0, "side").alias("reason"))
    good, bad = new_path(spark, "pairs"), new_path(spark, "rejects")
    for part in (2, 3, 0):
        sinks.accepted_and_rejected(rows.where(f"cast(id as long) % 4 = {part}"), good, bad)
    return files.json_lines(spark, good, "id string, reason string").unionByName(files.json_lines(spark, bad, "id string, reason string"))


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey not in (select l_orderkey from lineitem where l_quantity >= 49)")
def rewritten_without(spark, d):
    path = new_path(spark, "pairs")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    sinks.parquet(rows, path, "snappy")
    sinks.without(spark, path, rows.where("l_quantity >= 49"), "l_orderkey")
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber")


@query("select o_orderstatus as split, count(*) as n, count(*) as rows_seen, round_even(avg(o_totalprice), 2) as mean from orders group by 1")
def results_file(spark, d):
    """Counts taken while rows are written, and results as one JSON file."""
    rows, seen = sinks.counted(table(spark, d, "orders"), "orders", finished=F.col("o_orderstatus") == "F", open=F.col("o_orderstatus") == "O", partly=F.col("o_orderstatus") == "P")
    path = new_path(spark, "out")
    sinks.parquet(rows, path)
    counts = dict(zip("FOP", [seen.get[k] for k in ("finished", "open", "partly")], strict=True))
    got = {r["o_orderstatus"]: {"n": r["n"], "mean": r["m"]} for r in spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.bround(F.avg("o_totalprice"), 2).alias("m")).collect()}
    sinks.results(spark, {"results": got}, f"{path}.json")
    text = spark.read.text(f"{path}.json", wholetext=True).select(F.from_json("value", "results map<string, struct<n long, mean double>>").alias("r"))
    each = text.select(F.explode("r.results").alias("split", "x"))
    known = F.create_map(*[F.lit(x) for kv in counts.items() for x in kv])
    return each.select("split", "x.n", known[F.col("split")].alias("rows_seen"), "x.mean")


@query("select event_id, value * 2 as twice from events where event_id % 3 <> 1")
def stream_incremental(spark, d):
    """Two parts of a growing folder, each read once, whatever runs in between."""
    e = table(spark, d, "events").select("event_id", "value")
    source, sink, state = (new_path(spark, t) for t in ("source", "sink", "state"))
    for part in (0, 2):
        e.where(F.col("event_id") % 3 == part).write.mode("append").parquet(source)
        for _ in range(2):
            incremental.consume(spark, e.schema, source, sink, state, lambda new: new.select("event_id", (F.col("value") * 2).alias("twice")))
    return spark.read.parquet(sink)


# ---- a map extract ----

ROAD = "case when k % 2 = 0 then 'residential' else 'tertiary' end"
ROAD_TAGS = f"""case when what = 'house' then 'footway' when what = 'round' then 'residential' else {ROAD} end as highway, case when what = 'house' then concat('House ', k) when what = 'round' then concat('Circle ', k) when k % 4 = 0 then concat('Row ', k) else '' end as name,
  case when k % 4 = 1 then concat('R', k) else '' end as ref, case when k % 5 = 2 then 'yes' else 'no' end as oneway, case when what = 'round' then 'roundabout' else '' end as junction, case when what = 'house' then 'yes' else '' end as building"""


def _extract(spark, d) -> tuple:
    """The grid as a map extract in XML, read back: nodes, some of them named, and ways."""
    path = new_path(spark, "map")
    tags = lambda names: F.filter(F.array(*[F.struct(F.lit(n).alias("_k"), F.col(n).alias("_v")) for n in names]), lambda x: F.length(x["_v"]) > 0).alias("tag")
    v = fixture(spark, d, "vertices")
    area, bank = F.col("node") % 97 == 5, F.col("node") % 22 == 0
    name = F.when(area, F.concat(F.lit("Area "), "node")).when(bank, F.concat(F.lit("Bank "), "node"))
    n = v.select("node", "lat", "lon", F.when(F.col("node") % 11 == 0, "bank").alias("amenity"), name.alias("name"), F.when(area, "suburb").alias("place"))
    n = n.select(F.col("node").alias("_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), tags(["amenity", "name", "place"]))
    ways = spark.sql(f"select * from {way_nodes('div')}").groupBy("way", "what", "k").agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("at"))
    ways = spark.sql(f"select way, at, {ROAD_TAGS} from {{w}}", w=ways)
    ways = ways.select(F.col("way").alias("_id"), F.transform("at", lambda x: F.struct(x["node"].alias("_ref"))).alias("nd"), tags(["highway", "name", "ref", "oneway", "junction", "building"]))
    for row, rows in (("node", n), ("way", ways)):
        rows.write.format("xml").option("rootTag", "osm").option("rowTag", row).save(f"{path}/{row}")
    nodes = map_nodes(spark, f"{path}/node")
    return nodes, map_ways(spark, f"{path}/way", nodes)


@query(f"""with p as (select *, {ROAD_TAGS} from {PIECES}),
  e as (select way, piece, 0 as back, src, dst, metres, coalesce(nullif(name, ''), nullif(ref, ''), '') as name, highway as kind from p union all select way, piece, 1, dst, src, metres, coalesce(nullif(name, ''), nullif(ref, ''), ''), highway from p where oneway <> 'yes')
  select src, dst, round_even(metres, 1) as metres, name, kind from (select *, row_number() over (partition by src, dst order by way desc, piece desc, back desc) as n from e) where n = 1""")
def map_extract_edges(spark, d):
    _, ways = _extract(spark, d)
    return cities.edges(ways).select("src", "dst", F.bround("metres", 1).alias("metres"), "name", "kind")


HOUSES = f"(select w.way, w.pos, w.node, w.what, w.k, v.lat, v.lon from {way_nodes('//')} w join {V} v using (node))"


@query(f"""select case when node % 97 = 5 then concat('Area ', node) else concat('Bank ', node) end as name, case when node % 97 = 5 and node % 11 <> 0 then 'area' else 'bank' end as cat, case when node % 97 = 5 and node % 11 <> 0 then 4 else 2 end as imp, round_even(lat, 5) as lat, round_even(lon, 5) as lon from {V} where node % 22 = 0 or node % 97 = 5
  union all select concat('House ', any_value(k)), 'building', 2, round_even(avg(lat), 5), round_even(avg(lon), 5) from {HOUSES} where what = 'house' group by way
  union all select concat('Circle ', any_value(k)), 'roundabout', 4, round_even(first(lat order by pos), 5), round_even(first(lon order by pos), 5) from {HOUSES} where what = 'round' group by way""")
def map_extract_landmarks(spark, d):
    nodes, ways = _extract(spark, d)
    return cities.named_things(nodes, ways).select("name", "cat", "imp", F.bround("lat", 5).alias("lat"), F.bround("lon", 5).alias("lon"))


@query(f"select way, round_even(avg(lat), 6) as lat, round_even(avg(lon), 6) as lon from {HOUSES} where way < 500000 group by way")
def way_centroids(spark, d):
    _, ways = _extract(spark, d)
    return cities.centroids(ways).select("way", F.bround("lat", 6).alias("lat"), F.bround("lon", 6).alias("lon"))


@query()
def city_build(spark, d):
    """A whole city from an extract and places, saved and loaded."""
    nodes, ways = _extract(spark, d)
    world, _ = cities.build("grid", nodes, ways, _places(spark, d), ["accra", "tema", "grid"])
    path = new_path(spark, "world")
    cities.save(world, path)
    return cities.load(spark, "grid", path).landmarks


def _places(spark, d):
    k = F.col("p_partkey")
    said = ["Retail > Market", "Dining > Bar", "Business > Office", "Health > Hospital"]
    name = F.when(k % 10 == 0, F.concat(F.lit("  Tema   Stop "), k)).when(k % 10 == 1, F.lit("Bar")).when(k % 10 == 2, F.concat(F.lit("Block "), k)).otherwise(F.concat(F.lit("Place "), F.col("p_name"), F.lit(" no "), (k % 89).cast("string")))
    return table(spark, d, "part").select(
        k.cast("string").alias("fsq_place_id"), F.when(k % 13 != 0, name).alias("name"), (6.58 + (k % 41) * 0.0009).alias("latitude"), (-1.75 + (k % 37) * 0.0009).alias("longitude"),
        F.array(F.get(F.array(*map(F.lit, said)), (k % 4).cast("int"))).alias("fsq_category_labels"), F.when(k % 17 == 0, "2020-01-01").alias("date_closed"), F.when(k % 7 != 0, F.concat((2010 + k % 12).cast("string"), F.lit("-05-01"))).alias("date_refreshed"),
    )


@query(r"""select id, cat, imp from (select p_partkey::varchar as id, p_partkey as k, case p_partkey % 4 when 0 then 'market' when 1 then 'eatery' when 3 then 'hospital' end as cat, case p_partkey % 4 when 0 then 5 when 1 then 2 when 3 then 4 end as imp,
    case when p_partkey % 7 <> 0 then 2010 + p_partkey % 12 else 0 end as year, 6.58 + (p_partkey % 41) * 0.0009 as lat from part)
  where cat is not null and k % 13 <> 0 and k % 17 <> 0 and k % 10 not in (0, 1, 2) and (year >= 2016 or cat <> 'eatery') and lat between 6.58 and 6.6007""")
def usable_places(spark, d):
    """Open places with a category and a name of their own in a box; names of other cities, rooms and stale eateries are left out."""
    return cities.usable_places(_places(spark, d), (6.58, 6.6007, -2.0, -1.0), "grid", ["accra", "tema", "grid"]).select("id", "cat", "imp")


@query(r"select p_partkey, (p_partkey % 3 = 0 and p_partkey % 2 = 0) or p_partkey % 3 = 1 as other from part")
def other_city_names(spark, d):
    """A city's own name does not count, nor does a part of a word."""
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, "Tema Market").when(k % 3 == 1, "the CAPE COAST stop").otherwise("Hotel Accrazy")
    home = F.when(k % 2 == 0, "Accra").otherwise("Tema")
    return table(spark, d, "part").select("p_partkey", cities.names_other_city(name, home, ["accra", "tema", "cape coast", "ho"]).alias("other"))


@query(f"""select name from (select concat('Shop ', id % 40) as name, id, node from {L}) where name not in (select concat('Shop ', id % 40) from {L} where id % 7 = 0) group by name""")
def names_not_taken(spark, d):
    """Places at a road, each name once, none that the map has."""
    w, _ = city(spark, d)
    shops = fixture(spark, d, "landmarks").withColumn("name", F.concat(F.lit("Shop "), (F.col("id") % 40).cast("string")))
    at = cities.at_roads(shops.drop("node"), w.nodes, "id").withColumn("low", F.lower("name"))
    free = at.join(shops.where("id % 7 = 0").select(F.lower("name").alias("low")).distinct(), "low", "left_anti")
    return files.first_per_key(free, "low", "id").select("name")


AMENITY = ["marketplace", "bus_station", "hospital", "police", "place_of_worship", "school", "bank", "fuel", "pharmacy", "pub", "doctors", "fire_station", "atm", "parking", "college", "town_hall"]
AMENITY_CAT = ["market", "lorry park", "hospital", "police station", "church", "school", "bank", "filling station", "pharmacy", "eatery", "clinic", "fire station", "ATM", None, "school", None]
AMENITY_IMP = [5, 5, 4, 3, 2, 3, 2, 2, 2, 2, 2, 3, 2, None, 3, None]
OTHERS = [("junction", "roundabout", "roundabout", 4), ("tourism", "museum", "museum", 3), ("tourism", "motel", None, None), ("leisure", "park", "park", 4), ("shop", "mall", "mall", 4), ("railway", "station", "railway station", 4), ("highway", "bus_stop", "bus stop", 2), ("public_transport", "station", "bus stop", 2), ("shop", "books", "shop", 2), ("building", "yes", "building", 2), ("place", "town", "area", 4), ("place", "city", None, None)]
_LIT = lambda x: "null" if x is None else repr(x)


@query(f"""with t as (select p_partkey as k, p_partkey % {len(AMENITY) + 1} as i, p_partkey // 3 % {len(OTHERS)} as j from part)
  select k, case when i = 4 and k % 2 = 0 then 'mosque' when a.cat is not null and (a.rank < 8 or b.rank is null or b.rank > 13) then a.cat when b.cat is not null and (a.cat is null or b.rank <= 13) then b.cat else coalesce(a.cat, b.cat) end as cat
  from t left join (values {", ".join(f"({i}, {_LIT(c)}, {i if i < 8 else 14})" for i, c in enumerate(AMENITY_CAT) if c)}, ({14}, 'school', 5)) a(i2, cat, rank) on a.i2 = i and a.rank <> 14 + (case when a.i2 = 14 then 0 else 1 end)
  left join (values {", ".join(f"({j}, {_LIT(c)}, {8 + j if j < 6 else 20 + j})" for j, (_, _, c, _) in enumerate(OTHERS) if c)}) b(j2, cat, rank) on b.j2 = j""")
def categorize_tags(spark, d):
    k = F.col("p_partkey")
    amenity = F.get(F.array(*map(F.lit, AMENITY)), (k % (len(AMENITY) + 1)).cast("int"))
    j = (F.floor(k / 3) % len(OTHERS)).cast("int")
    other = F.get(F.array(*[F.struct(F.lit(a).alias("k"), F.lit(b).alias("v")) for a, b, _, _ in OTHERS]), j)
    entries = F.array(F.struct(F.lit("name").alias("k"), F.lit("x").alias("v")), F.struct(F.lit("religion").alias("k"), F.when(k % 2 == 0, "muslim").otherwise("other").alias("v")), F.struct(F.lit("amenity").alias("k"), F.coalesce(amenity, F.lit("")).alias("v")), other)
    return table(spark, d, "part").select(k.alias("k"), landmarks.tag_category(F.map_from_entries(entries))["cat"].alias("cat"))


@query("select doc_id, case when doc_id % 3 = 0 then 'route' when doc_id % 3 = 1 then 'short_hop' else 'other' end as task, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) > case doc_id % 3 when 0 then 110 when 1 then 60 else 85 end as too_long from documents")
def word_caps(spark, d):
    from trailhead.functions import facts

    k = F.col("doc_id")
    task = F.when(k % 3 == 0, "route").when(k % 3 == 1, "short_hop").otherwise("other")
    caps = F.create_map(*[F.lit(x) for pair in facts.MOST_WORDS.items() for x in pair])
    return table(spark, d, "documents").select("doc_id", task.alias("task"), (F.size(S.words(F.col("text"))) > F.coalesce(caps[task], F.lit(85))).alias("too_long"))


@query(f"with recursive e as (select src, dst from {duck('edges')}), f(node) as (select 41 union select e.dst from f join e on e.src = f.node), b(node) as (select 41 union select e.src from b join e on e.dst = b.node) select f.node::bigint as node from f join b using (node)")
def largest_scc(spark, d):
    return roads.largest_strong_part(fixture(spark, d, "edges").select("src", "dst"))
