"""Draws scenarios over a city: each draw picks a task, its ends and its variant by hashes of its number, all draws at once.

Two rounds of routing serve every task: the plain route, then the second one (way back, or round what is to be avoided).
A draw that fails a test gives no scenario.  New tasks are entries of ``TASKS``, or functions registered by ``task``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailhead.functions import scalar as S
from trailhead.operators import roads, spatial, walk
from trailhead.operators.walk import World
from trailhead.sources.stages import settled


@dataclass(frozen=True)
class Task:
    """``least`` to ``most`` metres in a straight line; a route may have ``factor`` times that and ``slack`` more."""

    weight: int
    start: str  # "major", "poi" or "point"; "own" if a function makes the whole scenario
    least: float
    most: float
    min_steps: int
    second: str | None = None  # "back", "landmark" or "road"
    factor: float = 2.2
    slack: float = 800.0


# Weights, distance bands, steps and detours of the tasks.
TASKS = {
    "route": Task(20, "major", 1000, 12000, 2),
    "reverse": Task(12, "major", 1000, 12000, 2, "back"),
    "short_hop": Task(12, "poi", 150, 800, 0, None, 3.0, 300.0),
    "avoid_landmark": Task(12, "major", 2000, 12000, 3, "landmark"),
    "avoid_road": Task(8, "major", 2000, 12000, 3, "road"),
    "gps_start": Task(14, "point", 800, 9000, 0),
    "nearby": Task(8, "own", 0, 0, 0),
    "connects": Task(8, "major", 1500, 10000, 3),
}
#: What makes the scenarios of the tasks whose start is "own".
MAKERS: dict[str, Callable[[World, DataFrame, DataFrame, Pools], DataFrame]] = {}
TRIES = 80
PLACE = "struct<name:string,lat:double,lon:double,area:string,type:string>"
SIGHT = "struct<name:string,type:string,dist_m:int,direction:string>"


@dataclass(frozen=True)
class Pools:
    """A city's important landmarks, all its landmarks and its nodes, each numbered from 0 in column ``at``."""

    major: DataFrame
    poi: DataFrame
    nodes: DataFrame


def task(name: str, weight: int):
    """Registers a task of its own: a function of a world, its areas, the task's draws (draw, task) and the pools, which gives
    rows of draw, part, task, start, pair and any further facts of scenarios; draws without a row give none."""

    def register(make):
        TASKS[name], MAKERS[name] = Task(weight, "own", 0, 0, 0), make
        return make

    return register


def chance(*salt) -> Column:
    """A number in [0, 1) from the draw and the salt."""
    return F.pmod(F.xxhash64("draw", *[s if isinstance(s, Column) else F.lit(s) for s in salt]), F.lit(1 << 40)) / float(1 << 40)


def of_task(make, default=None) -> Column:
    """A CASE over the tasks."""
    out = None
    for name, t in TASKS.items():
        out = F.when(F.col("task") == name, make(t)) if out is None else out.when(F.col("task") == name, make(t))
    return out.otherwise(default)


def draws(spark, n: int, tasks: list[str] | None = None) -> DataFrame:
    """draw, task: by the tasks' weights."""
    names = tasks or list(TASKS)
    at, sums = 0, []
    for name in names:
        at += TASKS[name].weight
        sums.append((name, at))
    pick = F.col("_u") * at
    task = F.lit(None).cast("string")
    for name, upto in reversed(sums):
        task = F.when(pick < upto, name).otherwise(task)
    return spark.range(n).withColumnRenamed("id", "draw").withColumn("_u", chance("task")).select("draw", task.alias("task"))


def _numbered(rows: DataFrame, order: str) -> DataFrame:
    """Rows numbered from 0 (``at``) by ``order``: they are dealt by ranges of it, and only the ranges' counts are summed in one place."""
    dealt = settled(rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_range").agg(F.count("*").alias("n")).select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return dealt.withColumn("at", place).join(F.broadcast(base), "_range").withColumn("at", F.col("at") + F.col("_base")).drop("_range", "_base")


def _place(prefix: str) -> Column:
    return F.struct(*[F.col(f"{prefix}.{c}").alias(t) for c, t in (("name", "name"), ("lat", "lat"), ("lon", "lon"), ("area", "area"), ("cat", "type"))])


def _pairs(drawn: DataFrame, pool: DataFrame) -> DataFrame:
    """Each draw's first of TRIES pairs of different places in its distance band."""
    n = pool.count()
    if n < 2:
        return drawn.withColumns({"a": F.lit(None), "b": F.lit(None), "metres": F.lit(None)}).where("false")
    tried = drawn.withColumn("try", F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1))))
    tried = tried.withColumn("i", F.floor(chance("a", F.col("try")) * n)).withColumn("j", F.floor(chance("b", F.col("try")) * (n - 1)))
    tried = tried.withColumn("j", F.when(F.col("j") >= F.col("i"), F.col("j") + 1).otherwise(F.col("j")))
    whole = F.struct("id", "name", "lat", "lon", "area", "cat", "node")
    rows = pool.select("at", whole.alias("x"))
    both = tried.join(rows.select(F.col("at").alias("i"), F.col("x").alias("a")), "i").join(rows.select(F.col("at").alias("j"), F.col("x").alias("b")), "j")
    d = S.great_circle(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    fit = both.withColumn("d", d).where((F.col("a.node") != F.col("b.node")) & (F.col("d") >= of_task(lambda t: t.least)) & (F.col("d") <= of_task(lambda t: t.most)))
    return fit.groupBy("draw", "task").agg(F.min_by(F.struct("a", "b", "d"), "try").alias("f")).select("draw", "task", F.col("f.a").alias("a"), F.col("f.b").alias("b"), F.col("f.d").alias("d"))


def _points(drawn: DataFrame, nodes: DataFrame, areas: DataFrame) -> DataFrame:
    """draw, task, lat, lon, area: a node moved by up to 0.0003 degrees."""
    picked = drawn.withColumn("at", F.floor(chance("node") * nodes.count())).join(nodes, "at")
    shift = lambda salt: (chance(salt) * 2 - 1) * 3e-4
    moved = picked.select("draw", "task", (F.col("lat") + shift("up")).alias("lat"), (F.col("lon") + shift("over")).alias("lon"))
    return moved.join(spatial.nearest_of_few(moved, areas, "draw"), "draw", "left").withColumn("area", F.coalesce("area", F.lit("")))


def _near(points: DataFrame, world: World, key: str, radius: float) -> DataFrame:
    return walk.sights_of(points, world, key, radius, 25, 2)


def _length(paths: DataFrame) -> DataFrame:
    return paths.withColumnRenamed("metres", "length").where("path is not null")


def _route(queries: DataFrame, world: World) -> DataFrame:
    """query, length, path."""
    return _length(roads.shortest(queries, world.edges))


def _starts(world: World, areas: DataFrame, drawn: DataFrame, pools: Pools) -> DataFrame:
    """draw, task, a, b, d, near (struct, points only): the ends of every draw that has a route."""
    of_kind = lambda kind: drawn.where(F.col("task").isin([k for k, t in TASKS.items() if t.start == kind]))
    ends = _pairs(of_kind("major"), pools.major).unionByName(_pairs(of_kind("poi"), pools.poi)).withColumn("near", F.lit(None).cast(SIGHT))
    points = _points(drawn.where("task = 'gps_start'"), pools.nodes, areas)
    near = _near(points, world, "draw", 400.0).select("draw", walk.spoken_sight(F.get("sights", F.lit(0))).alias("near"))
    snap = spatial.nearest(points, world.nodes.select("node", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")), "draw", "node", 80.0).select("draw", "node")
    whole = F.struct("id", "name", "lat", "lon", "area", "cat", "node")
    goals = pools.major.select("at", whole.alias("b"))
    here = points.join(near, "draw").join(snap, "draw").withColumn("at", F.floor(chance("goal") * pools.major.count())).join(goals, "at")
    a = F.struct(
        F.concat(F.lit("gps:"), F.col("area")).alias("id"), F.lit(None).cast("string").alias("name"), F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"), "area", F.lit("gps point").alias("cat"), "node"
    )
    d = S.great_circle(F.col("lat"), F.col("lon"), F.col("b.lat"), F.col("b.lon"))
    here = here.select("draw", "task", a.alias("a"), "b", d.alias("d"), "near").where(F.col("d").between(TASKS["gps_start"].least, TASKS["gps_start"].most))
    return ends.unionByName(here)


def _names(*more) -> Column:
    return F.filter(F.array("a.name", "b.name", *more), lambda x: x.isNotNull())


@task("nearby", 8)
def _nearby(world: World, areas: DataFrame, drawn: DataFrame, pools: Pools) -> DataFrame:
    """The ``nearby`` task: a landmark or a point, even odds, with three to six landmarks within 800 m."""
    named = chance("named") < 0.5
    rows = pools.major.select("at", "name", "lat", "lon", "area", "cat")
    at_place = drawn.where(named).withColumn("at", F.floor(chance("place") * pools.major.count())).join(rows, "at").drop("at")
    at_point = _points(drawn.where(~named), pools.nodes, areas).withColumns({"name": F.lit(None).cast("string"), "cat": F.lit("gps point")})
    starts = at_place.unionByName(at_point)
    found = starts.join(_near(starts, world, "draw", 800.0), "draw")
    kept = F.slice(F.filter("sights", lambda x: F.col("name").isNull() | (x["name"] != F.col("name"))), 1, 6)
    by_distance = F.sort_array(F.transform(kept, lambda x, i: F.struct(S.spoken_metres(x["d"]).alias("m"), i.alias("i"), walk.spoken_sight(x).alias("s"))))
    found = found.withColumn("nearby", F.transform(by_distance, lambda x: x["s"])).where(F.size("nearby") >= 3)
    place = lambda c: F.when(F.col("name").isNull(), F.round(c, 5)).otherwise(F.col(c)).alias(c)
    start = F.struct("name", place("lat"), place("lon"), "area", F.col("cat").alias("type"), F.lit(None).cast(SIGHT).alias("near"))
    return found.select("draw", F.lit(0).alias("part"), "task", start.alias("start"), F.array(F.coalesce("name", F.concat(F.lit("gps:"), "area"))).alias("pair"), "nearby")


def _facts(rows: DataFrame, world: World) -> DataFrame:
    """Common facts of routed rows (draw, part, task, a, b, d, near, path, length, steps, last_*)."""
    beside = _near(world.sights().select(F.col("id").alias("b_id"), "lat", "lon"), world, "b_id", 100.0).withColumnRenamed("sights", "beside")
    rows = rows.withColumn("b_id", F.col("b.id")).join(beside, "b_id", "left")
    gap = S.great_circle(F.col("last_lat"), F.col("last_lon"), F.col("b.lat"), F.col("b.lon"))
    angle = S.turn_angle(S.heading(F.col("last_lat"), F.col("last_lon"), F.col("b.lat"), F.col("b.lon")), F.col("last_way"))
    others = F.slice(F.filter("beside", lambda x: ~F.array_contains(_names(), x["name"])), 1, 1)
    start = F.struct(*[F.col(f"a.{c}").alias(t) for c, t in (("name", "name"), ("lat", "lat"), ("lon", "lon"), ("area", "area"), ("cat", "type"))], F.col("near").alias("near"))
    km = lambda m: F.bround(m / 1000, 1)
    return rows.withColumns({
        "start": start, "end": _place("b"), "straight_km": km(F.col("d")), "route_km": km(F.col("length")),
        "bearing": S.compass(S.heading(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))),
        "dest_side": F.when(F.col("last_way").isNull() | (gap < 25), "ahead").otherwise(S.side(angle, 20, 160)),
        "dest_near": F.coalesce(F.transform(others, walk.spoken_sight), F.array().cast(f"array<{SIGHT}>")),
    })


def _with_steps(rows: DataFrame, world: World, exclude: Column) -> DataFrame:
    said = walk.describe(rows.select(F.col("draw").alias("query"), "path", exclude.alias("exclude")), world).withColumnRenamed("query", "draw")
    return rows.join(said, "draw", "left")


def _pick(options: Column, salt: str) -> Column:
    return F.get(options, F.floor(chance(salt) * F.size(options)).cast("int"))


def _question(rows: DataFrame, world: World) -> DataFrame:
    """The ``connects`` variants: a landmark on the way, one 500 to 2000 m off every node of the route, or only the link."""
    spots = F.flatten(F.transform("steps", lambda s: F.transform(s["landmarks_at_end"], lambda n: F.struct(n.alias("name"), s["road"].alias("road")))))
    rows = rows.withColumn("on", spots).withColumn("hit", F.when((chance("on") < 0.5) & (F.size("on") > 0), _pick(F.col("on"), "which")))
    away = rows.where("hit is null").select("draw", F.array_union(_names(), F.transform("on", lambda x: x["name"])).alias("said"), F.explode("path").alias("node"))
    away = away.join(world.nodes, "node").withColumn("key", F.struct("draw", "node"))
    places = world.sights().where("imp >= 3").select("id", "name", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    # the distance is measured on the plane at the landmark, so it takes the landmark's side of the pair
    plane = S.planar(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon"))
    close = spatial.within(away, places, 2010.0).withColumn("m", plane).where(~F.array_contains("said", F.col("name")))
    least = close.groupBy("draw", "id", "name").agg(F.min("m").alias("m")).where(F.col("m").between(500, 2000))
    off = least.groupBy("draw").agg(F.min_by(F.struct("name", "m"), F.xxhash64("draw", "id")).alias("off"))
    rows = rows.join(off, "draw", "left")
    hit, miss = F.col("hit").isNotNull(), F.col("off").isNotNull()
    return rows.withColumns({
        "variant": F.when(hit | miss, "on_the_way").otherwise("link"), "question_landmark": F.coalesce("hit.name", "off.name"), "on_route": F.when(hit, True).when(miss, False),
        "on_road": F.col("hit.road"), "off_route_m": F.when(~hit & miss, S.spoken_metres(F.col("off.m"))),
    })


def _second(rows: DataFrame, world: World) -> DataFrame:
    """The second route of ``reverse`` and the avoiding tasks, as rows of ``part`` 1."""
    said = F.flatten(F.transform(F.slice("steps", 1, F.size("steps") - 1), lambda s: s["landmarks_at_end"]))
    mids = F.filter(said, lambda n: ~F.array_contains(_names(), n))
    long_roads = F.transform(F.filter("steps", lambda s: ~s["generic"] & (s["dist_m"] >= 300)), lambda s: s["road"])
    kind = of_task(lambda t: F.lit(t.second))
    rows = rows.where(kind.isNotNull()).withColumn("what", F.when(F.col("task") == "avoid_landmark", _pick(mids, "what")).when(F.col("task") == "avoid_road", _pick(long_roads, "what")))
    rows = rows.where((F.col("task") == "reverse") | F.col("what").isNotNull())
    first = world.sights().groupBy(F.col("name").alias("what")).agg(F.min_by(F.struct("lat", "lon"), "id").alias("at")).select("what", "at.lat", "at.lon")
    shut = rows.where("task = 'avoid_landmark'").select("what").distinct().join(first, "what")
    inside = spatial.within(shut, world.nodes.select("node", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")), 150.0, few_points=True)
    shut = inside.groupBy("what").agg(F.collect_set("node").alias("banned"))
    rows = rows.withColumnRenamed("path", "path_1").withColumnRenamed("length", "length_1").drop("steps", "last_way", "last_lat", "last_lon").join(shut, "what", "left")
    back = F.col("task") == "reverse"
    rows = rows.withColumn("ends", F.when(back, F.struct(F.col("b").alias("a"), F.col("a").alias("b"))).otherwise(F.struct("a", "b")))
    rows = rows.withColumns({"a": F.col("ends.a"), "b": F.col("ends.b")}).drop("ends")
    banned = F.when(F.col("task") == "avoid_landmark", F.coalesce("banned", F.array().cast("array<bigint>")))
    asked = rows.select(F.col("draw").alias("query"), F.col("a.node").alias("src"), F.col("b.node").alias("dst"), banned.alias("banned"), F.when(F.col("task") == "avoid_road", F.col("what")).alias("banned_road"))
    rows = rows.drop("banned").join(_route(asked, world).withColumnRenamed("query", "draw"), "draw")
    other = F.col("path") != F.col("path_1")
    fit = (
        F.when(back, F.col("length") <= 2.2 * F.col("d") + 800)
        .when(F.col("task") == "avoid_landmark", other & F.col("length").between(1.02 * F.col("length_1"), 2.5 * F.col("length_1")))
        .otherwise(other & (F.col("length") <= 2.5 * F.col("length_1")))
    )
    rows = _with_steps(settled(rows.where(fit)), world, _names(F.when(F.col("task") == "avoid_landmark", F.col("what"))))
    rows = rows.where((F.col("task") != "avoid_road") | ~F.exists("steps", lambda s: s["road"] == F.col("what")))
    avoid = F.when(~back, F.struct(F.when(F.col("task") == "avoid_road", "road").otherwise("landmark").alias("kind"), F.col("what").alias("name")))
    return rows.withColumns({"part": F.lit(1), "avoid": avoid, "original_km": F.when(~back, F.bround(F.col("length_1") / 1000, 1))}).drop("what", "path_1", "length_1")


COMMON = ["draw", "part", "task", "start", "end", "pair", "straight_km", "route_km", "bearing", "steps", "dest_side", "dest_near"]
EXTRA = ["avoid", "original_km", "variant", "question_landmark", "on_route", "on_road", "off_route_m"]


def build(spark, world: World, areas: DataFrame, n: int, tasks: list[str] | None = None) -> DataFrame:
    """Scenarios of ``n`` draws, without repeats, numbered and split.  Each round's rows are written, as the next round reads them more than once."""
    drawn = draws(spark, n, tasks)
    world = World(world.city, settled(world.nodes), settled(world.edges), settled(world.landmarks))
    sights = world.sights()
    pools = Pools(_numbered(sights.where("imp >= 3"), "id"), _numbered(sights, "id"), _numbered(world.nodes, "node"))
    ends = settled(_starts(world, areas, drawn, pools))
    asked = ends.select(F.col("draw").alias("query"), F.col("a.node").alias("src"), F.col("b.node").alias("dst"), F.lit(None).cast("array<bigint>").alias("banned"), F.lit(None).cast("string").alias("banned_road"))
    first = ends.join(_route(asked, world).withColumnRenamed("query", "draw"), "draw")
    first = first.where(F.col("length") <= of_task(lambda t: t.factor) * F.col("d") + of_task(lambda t: t.slack))
    first = first.where((F.col("task") != "short_hop") | (F.size("path") >= 2))
    first = _with_steps(settled(first), world, _names()).where(F.coalesce(F.size("steps"), F.lit(0)) >= of_task(lambda t: t.min_steps))
    first = settled(first.withColumn("part", F.lit(0)))
    second = settled(_second(first, world))
    # the outward leg of a return trip counts as a plain route, and only if there is a way back
    outward = first.where("task = 'reverse'").join(second.select("draw"), "draw", "left_semi").withColumn("task", F.lit("route"))
    plain = first.where(F.col("task").isin("route", "short_hop", "gps_start"))
    asked_about = _question(first.where("task = 'connects'"), world)
    every = settled(plain.unionByName(outward).unionByName(second, allowMissingColumns=True).unionByName(asked_about, allowMissingColumns=True))
    pair = F.when((F.col("task") == "reverse"), F.array("b.id", "a.id")).otherwise(F.array("a.id", "b.id"))
    routed = _facts(every, world).withColumn("pair", pair).select(*COMMON, *EXTRA)
    for name, make in MAKERS.items():
        if tasks is None or name in tasks:
            routed = routed.unionByName(make(world, areas, drawn.where(F.col("task") == name), pools), allowMissingColumns=True)
    return numbered(split(distinct(routed)), world.city)


def enough(spark, world: World, areas: DataFrame, n: int, tasks: list[str] | None = None, most: int = 60) -> DataFrame:
    """``n`` scenarios, or as many as ``most * n`` draws give: draws are made anew, in growing numbers, until there are enough;
    then the first ``n`` are numbered without gaps.  A draw's outcome depends on its number alone, so more draws only add."""
    drawn = n
    while True:
        found = settled(build(spark, world, areas, drawn, tasks))
        got = found.count()
        if got >= n or drawn >= most * n:
            break
        drawn = min(most * n, max(2 * drawn, int(1.2 * drawn * n / max(got, 1))))
    # ids hold the draw's number, so their order is the draws' order
    first = found.withColumn("_at", F.regexp_extract("id", r"(\d+)$", 1).cast("long")).orderBy("_at").limit(n)
    place = F.row_number().over(Window.partitionBy("city").orderBy("_at")) - 1
    return first.withColumn("id", F.format_string("%s_%05d", F.lit(world.city), place)).drop("_at")


def of_cities(spark, worlds: dict[str, tuple[World, DataFrame]], n: int, tasks: list[str] | None = None) -> DataFrame:
    """Scenarios of several cities, ``n`` of each; ``city`` is a column of the result."""
    out = None
    for world, areas in worlds.values():
        rows = enough(spark, world, areas, n, tasks)
        out = rows if out is None else out.unionByName(rows)
    return out


def distinct(rows: DataFrame) -> DataFrame:
    """The first scenario of each task, ordered pair, avoided name, landmark asked about, and latitude if the start has no name."""
    key = F.struct("task", "pair", "avoid.name", "question_landmark", F.when(F.col("start.name").isNull(), F.col("start.lat")).alias("lat"))
    by = Window.partitionBy("_key").orderBy("draw", "part")
    return rows.withColumn("_key", key).withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n", "_key")


def split(rows: DataFrame) -> DataFrame:
    """Held-out areas, then held-out pairs whichever way round, then training."""
    held = lambda c: (F.length(F.coalesce(c, F.lit(""))) > 0) & (S.md5_mod(F.concat(F.lit("area:"), c), 10) == 0)
    areas = F.coalesce(held(F.col("start.area")), F.lit(False)) | F.coalesce(held(F.col("end.area")), F.lit(False))
    pairs = S.md5_mod(F.array_join(F.array_sort("pair"), "|"), 20) == 0
    return rows.withColumn("split", F.when(areas, "test_area").when(pairs, "test_pair").otherwise("train"))


def numbered(rows: DataFrame, city: str) -> DataFrame:
    """``id`` by draw and part (no gap-free numbers, which would need one task): unique, and stable from run to run."""
    number = F.col("draw") * 2 + F.col("part")
    return rows.withColumn("id", F.format_string("%s_%05d", F.lit(city), number)).withColumn("city", F.initcap(F.lit(city))).drop("draw", "part")
