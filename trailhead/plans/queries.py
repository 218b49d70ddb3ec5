"""Queries over the test tables and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailhead.functions import scalar as S
from trailhead.operators import landmarks, roads, spatial
from trailhead.plans.fixtures import SQL, duck, fixture
from trailhead.sources.tables import table
from trailhead.streaming import incremental

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
V, L, E = duck("vertices"), duck("landmarks"), duck("edges")
DUCK_PLANAR = "sqrt(((b.lat-a.lat)*111000.0)*((b.lat-a.lat)*111000.0) + ((b.lon-a.lon)*111000.0*cos(radians(a.lat)))*((b.lon-a.lon)*111000.0*cos(radians(a.lat))))"
DUCK_HEADING = "((degrees(atan2(sin(radians(b.lon-a.lon))*cos(radians(b.lat)), cos(radians(a.lat))*sin(radians(b.lat)) - sin(radians(a.lat))*cos(radians(b.lat))*cos(radians(b.lon-a.lon)))) + 360.0) % 360.0)"
DUCK_ROUND = "(case when {m} < 1000 then (case when round_even({m}/10,0)=0 then 10 else round_even({m}/10,0)*10 end) else round_even({m}/50,0)*50 end)::int"
POINTS = "['north','north-east','east','south-east','south','south-west','west','north-west']"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def _places(spark, d) -> DataFrame:
    return fixture(spark, d, "landmarks").select("id", "name", "imp", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))


@query(f"""select node, id, imp, rank::int as rank, {DUCK_ROUND.format(m='d')} as dist_m, {POINTS}[(floor((h+22.5)/45)::int % 8)+1] as direction from (
  select *, row_number() over (partition by node order by imp desc, d, id) as rank from (
    select a.node, b.id, b.imp, {DUCK_PLANAR} as d, {DUCK_HEADING} as h, row_number() over (partition by a.node order by {DUCK_PLANAR}, b.id) as n from {V} a, {L} b where {DUCK_PLANAR} <= 800) where n <= 25 and imp >= 2) where rank <= 2""")
def knn_landmarks(spark: SparkSession, d: str) -> DataFrame:
    found = spatial.top_nearby(fixture(spark, d, "vertices"), _places(spark, d), "node", 800.0, 2)
    return found.select("node", "id", "imp", F.col("rank").cast("int").alias("rank"), S.spoken_metres(F.col("d")).alias("dist_m"), S.compass(S.heading(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))).alias("direction"))


@query(f"""select id, node from (select a.id, b.node, row_number() over (partition by a.id order by {DUCK_PLANAR}, b.node) as n from {L} a, {V} b where {DUCK_PLANAR} <= 250) where n = 1""")
def nearest_node_snap(spark, d):
    nodes = fixture(spark, d, "vertices").select("node", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    return spatial.nearest(fixture(spark, d, "landmarks").select("id", "lat", "lon"), nodes, "id", "node", 250.0).select("id", "node")


@query(f"select a.id, b.node from {L} a, {V} b where {DUCK_PLANAR} <= 150")
def radius_nodes(spark, d):
    nodes = fixture(spark, d, "vertices").select("node", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    return spatial.within(fixture(spark, d, "landmarks").select("id", "lat", "lon"), nodes, 150.0, few_points=True).select("id", "node")


@query(f"""select a.node as src, b.node as dst, round_even(12742000.0*asin(sqrt(pow(sin(radians(b.lat-a.lat)/2),2)+cos(radians(a.lat))*cos(radians(b.lat))*pow(sin(radians(b.lon-a.lon)/2),2))),2) as metres,
  {POINTS}[(floor(({DUCK_HEADING}+22.5)/45)::int % 8)+1] as direction from {V} a join {V} b on b.node = a.node + 41""")
def haversine_compass(spark, d):
    a = fixture(spark, d, "vertices").select(F.col("node").alias("src"), F.col("lat").alias("la"), F.col("lon").alias("lo"))
    b = fixture(spark, d, "vertices").select(F.col("node").alias("dst"), (F.col("node") - 41).alias("src"), F.col("lat").alias("lb"), F.col("lon").alias("ob"))
    c = [F.col(x) for x in ("la", "lo", "lb", "ob")]
    return a.join(b, "src").select("src", "dst", F.bround(S.great_circle(*c), 2).alias("metres"), S.compass(S.heading(*c)).alias("direction"))


@query("""select event_id, case when abs(x)<25 then 'straight' when x>=135 then 'sharp right' when x>=60 then 'right' when x>=25 then 'slight right' when x>-60 then 'slight left' when x>-135 then 'left' else 'sharp left' end as turn,
  case when x>15 and x<165 then 'right' when x<-15 and x>-165 then 'left' else 'ahead' end as side from (select event_id, (event_id*37 % 360)::double - 180.0 as x from events)""")
def turn_classify(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("event_id") * 37 % 360 - 180.0).alias("x"))
    return e.select("event_id", S.turn_name(F.col("x")).alias("turn"), S.side(F.col("x"), 15, 165).alias("side"))


@query("""select key, name, imp, p_partkey, first_pos from (select lower(trim(p_name)) as key, p_name as name, p_size as imp, p_partkey, min(p_partkey) over (partition by lower(trim(p_name))) as first_pos,
  row_number() over (partition by lower(trim(p_name)) order by p_size desc, p_partkey) as n from part where length(lower(trim(p_name))) >= 3) where n = 1""")
def landmark_dedupe(spark, d):
    p = table(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_size").alias("imp"), "p_partkey")
    return landmarks.best_by_name(p, "p_partkey").select("key", "name", "imp", "p_partkey", "first_pos")


@query("""select src, dst, quantity from (select l_orderkey%50 as src, l_partkey%50 as dst, l_quantity as quantity, row_number() over (partition by l_orderkey%50, l_partkey%50 order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_shipdate desc) as n from lineitem) where n=1""")
def parallel_edge_collapse(spark, d):
    rows = table(spark, d, "lineitem").withColumns({"src": F.col("l_orderkey") % 50, "dst": F.col("l_partkey") % 50})
    return roads.collapse_parallel(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"], "l_quantity").withColumnRenamed("l_quantity", "quantity")


# Ways over the grid: every third row and fifth column, so that most nodes are no junctions; a roundabout at a row; a loop that meets no
# other way; two thirds of a block as a footpath, and a way one of whose nodes is not there.
LOOP = "(select * from (values (0, 0, 0), (1, 0, 1), (2, 1, 1), (3, 1, 0), (4, 0, 0)) as p(pos, dr, dc))"
WAY_NODES = f"""(select r as way, c as pos, node, 'road' as what, r as k from {{v}} where r % 3 = 0 and c <= 39
  union all select 100000 + c, r, node, 'road', c from {{v}} where c % 5 = 0
  union all select 200000 + a.r, p.pos, (a.r + p.dr) * 40 + 1 + p.dc, 'round', a.r from {{v}} a, {LOOP} p where a.c = 0 and a.r % 6 = 0 and (a.r + 2) * 40 < (select count(*) from customer)
  union all select 300000 + a.r, p.pos, (a.r + 1 + p.dr) * 40 + 1 + p.dc, 'road', a.r from {{v}} a, {LOOP} p where a.c = 0 and a.r % 3 = 0 and (a.r + 3) * 40 < (select count(*) from customer)
  union all select 400000 + a.r, p.pos, (a.r + p.dr) * 40 + 6 + p.dc, 'house', a.r from {{v}} a, {LOOP} p where a.c = 0 and a.r % 3 = 1 and (a.r + 2) * 40 < (select count(*) from customer)
  union all select 500000 + a.r, p.pos, case when p.pos = 2 then 900000000 + a.r else (a.r + p.dr) * 40 + 8 + p.dc end, 'road', a.r from {{v}} a, {LOOP} p where a.c = 0 and a.r % 6 = 0 and (a.r + 2) * 40 < (select count(*) from customer))"""


def way_nodes(engine: str) -> str:
    """SQL of the ways' nodes, for "div" (Spark) or "//" (DuckDB) as the whole-number division."""
    return WAY_NODES.replace("{v}", "(" + SQL["vertices"].format(div=engine) + ")")


#: Nodes of whole ways that are roads, with their places.
WAYS = f"(select w.way, w.pos, w.node, w.what, w.k, v.lat, v.lon from {way_nodes('//')} w join {V} v using (node) where w.way not between 400000 and 599999)"
PIECES = f"""(select way, piece, first(node order by pos) as src, last(dst order by pos) as dst, sum(m) as metres, any_value(what) as what, any_value(k) as k from (
  select *, sum(case when refs >= 2 or pos = least_pos then 1 else 0 end) over (partition by way order by pos) as piece, 12742000.0*asin(sqrt(pow(sin(radians(lat2-lat)/2),2)+cos(radians(lat))*cos(radians(lat2))*pow(sin(radians(lon2-lon)/2),2))) as m from (
    select w.*, refs, min(pos) over (partition by way) as least_pos, lead(w.node) over o as dst, lead(lat) over o as lat2, lead(lon) over o as lon2 from {WAYS} w
    join (select node, sum(case when pos = a or pos = b then 2 else 1 end) as refs from (select *, min(pos) over (partition by way) as a, max(pos) over (partition by way) as b from {WAYS}) group by node) n on n.node = w.node window o as (partition by way order by pos)))
  where dst is not null group by way, piece having first(node order by pos) <> last(dst order by pos))"""


def _ways(spark, d):
    v = fixture(spark, d, "vertices")
    return spark.sql(f"select * from {way_nodes('div')} where way not between 400000 and 599999").join(v.select("node", "lat", "lon"), "node")


@query(f"select node, sum(case when pos=a or pos=b then 2 else 1 end)::bigint as refs from (select *, min(pos) over (partition by way) as a, max(pos) over (partition by way) as b from {WAYS}) group by node")
def junction_counts(spark, d):
    return roads.junctions(_ways(spark, d))


@query(f"select way, src, dst, round_even(metres, 1) as metres from {PIECES}")
def way_split_edges(spark, d):
    return roads.edges_of_ways(_ways(spark, d)).select("way", "src", "dst", F.bround("metres", 1).alias("metres"))


@query(f"select name, count(*) as n, sum(len_dm)::bigint as dm from {E} group by name")
def road_lengths(spark, d):
    return fixture(spark, d, "edges").groupBy("name").agg(F.count("*").alias("n"), F.sum("len_dm").alias("dm"))


def _routes(spark, d, banned, road):
    """From eight nodes, spread over the grid, to every node."""
    e = fixture(spark, d, "edges").withColumnRenamed("len_dm", "metres")
    v = fixture(spark, d, "vertices").select("node")
    step = v.count() // 8 + 1
    ends = v.where(F.col("node") % step == 0).select(F.collect_list("node").alias("s"))
    q = v.join(F.broadcast(ends), F.lit(True)).select(F.col("node").alias("dst"), F.explode("s").alias("src"))
    q = q.select((F.col("src") * 10000000 + F.col("dst")).alias("query"), "src", "dst", F.lit(banned).cast("array<bigint>").alias("banned"), F.lit(road).cast("string").alias("banned_road"))
    return roads.shortest(q, e, paths=False).select("query", F.coalesce(F.col("metres").cast("long"), F.lit(-1)).alias("dm"))  # -1: no way there


def _duck_routes(banned: str = "-1", road: str = "") -> str:
    start = f"(select node from {V} where node % ((select count(*) from customer) // 8 + 1) = 0)"
    return f"""with recursive e as (select src, dst, len_dm from {E} where dst not in ({banned}) and name is distinct from '{road or "-"}'),
      d(src, node, dm) using key (src, node) as (select node, node, 0::bigint from {start} where node not in ({banned})
        union select d.src, e.dst, min(d.dm + e.len_dm)::bigint from d join e on e.src = d.node left join recurring.d r on r.src = d.src and r.node = e.dst where r.dm is null or d.dm + e.len_dm < r.dm group by d.src, e.dst)
      select s.node * 10000000 + v.node as query, coalesce(d.dm, -1) as dm from {start} s, {V} v left join d on d.src = s.node and d.node = v.node"""


@query(_duck_routes())
def shortest_path_length(spark, d):
    return _routes(spark, d, None, None)


@query(_duck_routes("41, 42, 81"))
def avoid_nodes_length(spark, d):
    return _routes(spark, d, [41, 42, 81], None)


@query(_duck_routes(road="Row Road 0"))
def avoid_road_length(spark, d):
    return _routes(spark, d, None, "Row Road 0")


@query(f"""select a.node as query, count(e.src) as hops, case when count(e.src) = 5 then sum(e.len_dm)::bigint else -1 end as dm from {V} a left join (select * from {E} where dst = src + 1) e on e.src between a.node and a.node + 4
  where a.c <= 34 and a.node + 5 < (select count(*) from customer) group by a.node""")
def path_length(spark, d):
    v = fixture(spark, d, "vertices")
    n = v.count()
    paths = v.where((F.col("c") <= 34) & (F.col("node") + 5 < n)).select(F.col("node").alias("query"), F.sequence("node", F.col("node") + 5).alias("path"))
    edges = fixture(spark, d, "edges").withColumnRenamed("len_dm", "metres")
    found = roads.path_lengths(paths, edges)
    # hops that have an edge, as the SQL counts them
    real = paths.select("query", F.explode(F.slice("path", 1, 5)).alias("src")).join(edges.where("dst = src + 1").select("src"), "src").groupBy("query").agg(F.count("*").alias("hops"))
    return found.drop("hops").join(real, "query", "left").select("query", F.coalesce("hops", F.lit(0)).alias("hops"), F.coalesce(F.col("metres").cast("long"), F.lit(-1)).alias("dm"))


@query("""select user_id, run, min(event_type) as event_type, count(*) as n, round_even(sum(value),2) as total from (select *, sum(c) over (partition by user_id order by ts, event_id) as run from (
  select *, case when event_type = lag(event_type) over (partition by user_id order by ts, event_id) then 0 else 1 end as c from events)) group by user_id, run""")
def road_runs(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").withColumn("c", F.when(F.col("event_type") == F.lag("event_type").over(w), 0).otherwise(1)).withColumn("run", F.sum("c").over(w))
    return e.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.bround(F.sum("value"), 2).alias("total"))


_MD5 = "((((( (concat('0x',substr(h,1,8))::bigint % {m}) * (4294967296 % {m}) + concat('0x',substr(h,9,8))::bigint) % {m}) * (4294967296 % {m}) + concat('0x',substr(h,17,8))::bigint) % {m}) * (4294967296 % {m}) + concat('0x',substr(h,25,8))::bigint) % {m}"


@query(f"select o_orderkey, case when {_MD5.format(m=10)} = 0 then 'test_area' when {_MD5.format(m=20)} = 0 then 'test_pair' else 'train' end as split from (select o_orderkey, md5(o_orderkey::varchar) as h from orders)")
def md5_split(spark, d):
    k = F.col("o_orderkey").cast("string")
    return table(spark, d, "orders").select("o_orderkey", F.when(S.md5_mod(k, 10) == 0, "test_area").when(S.md5_mod(k, 20) == 0, "test_pair").otherwise("train").alias("split"))


@query("select o_orderkey from (select o_orderkey, row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey) as n from orders) where n = 1")
def scenario_dedupe(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("o_orderkey")).select("o_orderkey")


@query(r"""select doc_id, case when len(w) > 70 then 'input_long' when regexp_matches(text, '-?[0-9]{1,2}\.[0-9]{3,6}') then 'coord_in_input' when regexp_matches(text, '(?i)\b(north[- ]?east|north[- ]?west|south[- ]?east|south[- ]?west|north|south|east|west)\b') then 'direction' end as reason
  from (select doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') as w from documents)""")
def pair_reject_split(spark, d):
    t = F.col("text")
    way = r"(?i)\b(north[- ]?east|north[- ]?west|south[- ]?east|south[- ]?west|north|south|east|west)\b"
    reason = F.when(F.size(S.words(t)) > 70, "input_long").when(t.rlike(r"-?[0-9]{1,2}\.[0-9]{3,6}"), "coord_in_input").when(t.rlike(way), "direction")
    return table(spark, d, "documents").select("doc_id", reason.alias("reason"))


@query(r"select doc_id, trim(regexp_replace(replace(lower(text),'-',' '),'[^a-z0-9 ]','','g'), ' ') as norm from documents")
def norm_text(spark, d):
    return table(spark, d, "documents").select("doc_id", S.plain(F.col("text")).alias("norm"))


@query(r"select doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::int as n_words from documents")
def word_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(S.words(F.col("text"))).alias("n_words"))


@query("select conv_id, turn, n > 1 as duplicate from (select conv_id, turn, row_number() over (partition by conv_id, lower(trim(text)) order by turn) as n from conversations)")
def batch_duplicates(spark, d):
    w = Window.partitionBy("conv_id", F.lower(F.trim("text"))).orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", (F.row_number().over(w) > 1).alias("duplicate"))


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def resume_anti(spark, d):
    return incremental.not_done(table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("select l_orderkey, count(*) as n from lineitem where l_orderkey not in (select l_orderkey from lineitem where l_quantity >= 49) group by l_orderkey")
def clean_groups(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.join(rows.where("l_quantity >= 49").select("l_orderkey").distinct(), "l_orderkey", "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("select l_orderkey, min(l_linenumber)::int as l_linenumber from lineitem group by l_orderkey")
def first_per_key(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("l_linenumber"))


@query("select o_orderpriority, count(*) as n, count(*) filter (o_orderstatus='F') as f, count(*) filter (o_orderstatus='O') as o, count(*) filter (o_orderstatus='P') as p from orders group by 1")
def split_counts_pivot(spark, d):
    c = lambda s: F.count_if(F.col("o_orderstatus") == s).alias(s.lower())
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), c("F"), c("O"), c("P"))


@query("select event_type, n, row_number() over (order by n desc, event_type)::int as rank from (select event_type, count(*) as n from events group by 1)")
def ranked_counts(spark, d):
    n = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "event_type")))


@query("select coalesce(o_orderpriority,'all') as priority, coalesce(o_orderstatus,'all') as status, count(*) as n from orders group by cube(o_orderpriority, o_orderstatus)")
def grouping_sets_counts(spark, d):
    g = table(spark, d, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    return g.select(F.coalesce("o_orderpriority", F.lit("all")).alias("priority"), F.coalesce("o_orderstatus", F.lit("all")).alias("status"), "n")


@query("select lang, count(*) as n, round_even(avg(quality),3) as pass_rate, round_even(100.0*sum(1-quality)/count(*),0) as reject_pct from documents join labels using (doc_id) group by lang")
def task_pass_rate(spark, d):
    j = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return j.groupBy("lang").agg(F.count("*").alias("n"), F.bround(F.avg("quality"), 3).alias("pass_rate"), F.bround(100.0 * F.sum(1 - F.col("quality")) / F.count("*"), 0).alias("reject_pct"))


@query("""select a.l_orderkey, a.l_linenumber as i, b.l_linenumber as j, b.s - a.s + a.q as total from (select l_orderkey, l_linenumber, l_quantity as q, sum(l_quantity) over (partition by l_orderkey order by l_linenumber, l_partkey) as s from lineitem) a
  join (select l_orderkey, l_linenumber, sum(l_quantity) over (partition by l_orderkey order by l_linenumber, l_partkey) as s from lineitem) b on a.l_orderkey=b.l_orderkey and a.l_linenumber < b.l_linenumber""")
def contiguous_spans(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    r = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.sum("l_quantity").over(w).alias("s"))
    a, b = r.alias("a"), r.alias("b")
    return a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_linenumber") < F.col("b.l_linenumber"))).select("a.l_orderkey", F.col("a.l_linenumber").alias("i"), F.col("b.l_linenumber").alias("j"), (F.col("b.s") - F.col("a.s") + F.col("a.l_quantity")).alias("total"))


@query("""select o_orderkey, s as style from (select o_orderkey, s, row_number() over (partition by o_orderkey order by md5(concat(o_orderkey, s)), s) as n from orders, (select unnest(['casual','formal','rushed','polite','short','car','names']) as s)) where n <= 5""")
def style_sample(spark, d):
    styles = F.array(*map(F.lit, ["casual", "formal", "rushed", "polite", "short", "car", "names"]))
    keyed = F.transform(styles, lambda s: F.struct(F.md5(F.concat(F.col("o_orderkey").cast("string"), s).cast("binary")).alias("h"), s.alias("s")))
    return table(spark, d, "orders").select("o_orderkey", F.explode(F.slice(F.array_sort(keyed), 1, 5)).alias("x")).select("o_orderkey", F.col("x.s").alias("style"))


# Labels of places, and the category that each must have, worked out by hand.
LABELLED = [
    ("Dining and Drinking > Bar", "eatery"), ("Travel > Bus Stops", "bus stop"), ("Retail > Flea MARKET", "market"), ("Business > Office", None), ("Outdoors > Car Park", "park"), ("Retail > Supermarket", "market"),
    ("Café, Coffee, and Tea House", "eatery"), ("Lodging > Hotel Bar", "hotel"), ("Travel > Bus Station", "lorry park"), ("Education > College", "school"), ("Health > Eye Clinic", "clinic"), ("Fuel Station", "filling station"),
    ("Bank > ATM", "bank"), ("Community > Police Station", "police station"), ("Shopping Mall", "mall"), ("Spiritual Center > Mosque", "mosque"), ("Fast Food Restaurant", "eatery"), ("", None),
]


@query("select p_partkey, coalesce(a.cat, b.cat) as cat from part join (values " + ", ".join(f"({i}, {'null' if c is None else repr(c)})" for i, (_, c) in enumerate(LABELLED)) + f") a(i, cat) on a.i = p_partkey % {len(LABELLED)} join (values " + ", ".join(f"({i}, {'null' if c is None else repr(c)})" for i, (_, c) in enumerate(LABELLED)) + f") b(i, cat) on b.i = p_partkey // 7 % {len(LABELLED)}")
def classify_labels(spark, d):
    said = F.array(*[F.lit(x) for x, _ in LABELLED])
    labels = F.array(F.get(said, (F.col("p_partkey") % len(LABELLED)).cast("int")), F.get(said, (F.floor(F.col("p_partkey") / 7) % len(LABELLED)).cast("int")))
    return table(spark, d, "part").select("p_partkey", landmarks.classify(labels)["cat"].alias("cat"))


@query("select id, case when d < 60 then 'right beside it' when d < 250 then 'a short walk away' else 'a bit further on' end as wording from (select s_suppkey as id, (s_suppkey * 37) % 500 as d from supplier)")
def near_wording(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), S.near_word(F.col("s_suppkey") * 37 % 500).alias("wording"))
