"""Map extracts, files, the injected generator, city building and scenario counts."""

import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

from trailhead.operators import city as cities
from trailhead.operators import generation, roads, scenarios, walk
from trailhead.plans.fixtures import city, fixture
from trailhead.sources import files, pbf, sinks
from trailhead.sources.stages import new_path, settled
from trailhead.sources.tables import map_nodes, map_ways

SF = "/root/testdata/sf0.001"
NODES = [(i, 6.5 + i * 0.001, -1.7 - i * 0.0005, {"name": f"Bank {i}", "amenity": "bank"} if i % 3 == 0 else {}) for i in range(1, 13)]
WAYS = [
    (100, [1, 2, 3, 4], {"highway": "residential", "name": "First"}), (101, [4, 5, 6, 1], {"highway": "tertiary", "ref": "R1"}), (102, [7, 8, 9, 7], {"highway": "primary"}), (103, [10, 99], {"highway": "residential"}),
    (104, [2, 11, 5], {"highway": "service"}), (105, [3, 5], {"highway": "unclassified", "oneway": "yes"}), (106, [10, 11, 12, 10], {"building": "yes", "name": "Hall"}),
]


def xml(path):
    tags = lambda t: "".join(f'<tag k="{k}" v="{v}"/>' for k, v in t.items())
    lines = [f'<node id="{i}" lat="{a!r}" lon="{o!r}">{tags(t)}</node>' for i, a, o, t in NODES] + [f'<way id="{i}">' + "".join(f'<nd ref="{n}"/>' for n in r) + tags(t) + "</way>" for i, r, t in WAYS]
    path.write_text('<?xml version="1.0"?>\n<osm version="0.6">\n' + "\n".join(lines) + "\n</osm>\n")
    return f"file://{path}"


def varint(n):
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def field(n, value):
    return varint(n << 3) + varint(value) if isinstance(value, int) else varint(n << 3 | 2) + varint(len(value)) + value


def zig(n):
    return n << 1 if n >= 0 else (-n << 1) - 1


def packed(values, signed=True):
    last, out = 0, b""
    for v in values:
        out += varint(zig(v - last) if signed else v)
        last = v
    return out


def binary(path, dense=True, compressed=True):
    texts = ["", *sorted({x for t in [*(n[3] for n in NODES), *(w[2] for w in WAYS)] for kv in t.items() for x in kv})]
    at = {t: i for i, t in enumerate(texts)}
    unit = lambda x: round(x * 1e7)
    if dense:
        said = packed([x for n in NODES for x in [*(at[y] for kv in n[3].items() for y in kv), 0]], False)
        nodes = field(2, field(1, packed([n[0] for n in NODES])) + field(8, packed([unit(n[1]) for n in NODES])) + field(9, packed([unit(n[2]) for n in NODES])) + field(10, said))
    else:
        nodes = b"".join(field(1, field(1, zig(i)) + field(2, packed([at[k] for k in t], False)) + field(3, packed([at[v] for v in t.values()], False)) + field(8, zig(unit(a))) + field(9, zig(unit(o)))) for i, a, o, t in NODES)
    ways = b"".join(field(3, field(1, i) + field(2, packed([at[k] for k in t], False)) + field(3, packed([at[v] for v in t.values()], False)) + field(8, packed(r))) for i, r, t in WAYS)
    table = field(1, b"".join(field(1, t.encode()) for t in texts))
    out = b""
    for kind, block in (("OSMHeader", b"x"), ("OSMData", table + field(2, nodes)), ("OSMData", table + field(2, ways) + field(17, 100))):
        blob = field(2, len(block)) + field(3, zlib.compress(block)) if compressed else field(1, block)
        head = field(1, kind.encode()) + field(3, len(blob))
        out += struct.pack(">I", len(head)) + head + blob
    path.write_bytes(out)
    return f"file://{path}"


@pytest.mark.parametrize("kind", ["xml", "dense", "plain"])
def test_map_extract(spark, tmp_path, kind):
    path = xml(tmp_path / "a.osm") if kind == "xml" else binary(tmp_path / "a.pbf", kind == "dense", kind == "dense")
    nodes = map_nodes(spark, path)
    got = {r["node"]: r for r in nodes.collect()}
    assert len(got) == 12
    for i, lat, lon, tags in NODES:
        assert abs(got[i]["lat"] - lat) < 1e-6 and abs(got[i]["lon"] - lon) < 1e-6 and got[i]["tags"] == tags
    ways = map_ways(spark, path, nodes)
    rows = {}
    for r in ways.collect():
        rows.setdefault(r["way"], []).append((r["pos"], r["node"]))
    assert {w: [n for _, n in sorted(v)] for w, v in rows.items()} == {i: r for i, r, _ in WAYS if 99 not in r}
    edges = {(r["src"], r["dst"]): (r["name"], r["kind"]) for r in cities.edges(ways).collect()}
    both = lambda a, b, v: {(a, b): v, (b, a): v}
    # 3 and 5 are junctions by the one-way 105; the closed way 102 and the service road 104 give nothing
    want = {**both(1, 3, ("First", "residential")), **both(3, 4, ("First", "residential")), **both(4, 5, ("R1", "tertiary")), **both(5, 1, ("R1", "tertiary")), (3, 5): ("", "unclassified")}
    assert edges == want
    things = {r["name"]: (r["cat"], round(r["lat"], 6)) for r in cities.named_things(nodes, ways).collect()}
    assert things == {**{f"Bank {i}": ("bank", round(6.5 + i * 0.001, 6)) for i in (3, 6, 9, 12)}, "Hall": ("building", round(6.5 + (10 + 11 + 12 + 10) / 4 * 0.001, 6))}


def test_city(spark, tmp_path):
    path = xml(tmp_path / "a.osm")
    nodes = map_nodes(spark, path)
    places = [("p1", "Golden  Hotel", 6.5021, -1.7011, ["Hotel"], None, None), ("p2", "golden hotel", 6.5032, -1.7016, ["Hotel"], None, "2020"), ("p3", "Old Bar", 6.502, -1.7011, ["Bar"], None, "2015-01-01"), ("p4", "Bank 3", 6.503, -1.7015, ["Bank"], None, "2020"), ("p5", "Far Market", 6.5, -1.3, ["Market"], None, "2020")]
    rows = spark.createDataFrame(places, "fsq_place_id string, name string, latitude double, longitude double, fsq_category_labels array<string>, date_closed string, date_refreshed string")
    world, areas = cities.build("t", nodes, map_ways(spark, path, nodes), rows, ["t", "u"])
    assert sorted(r["node"] for r in world.nodes.collect()) == [1, 3, 4, 5]
    found = {r["name"]: (r["id"], r["node"], r["source"], r["area"]) for r in world.landmarks.collect()}
    assert found["Bank 3"] == ("t_0", 3, "osm", "") and found["Golden Hotel"][1:] == (3, "foursquare", "") and set(found) == {"Bank 3", "Bank 6", "Golden Hotel"}
    cities.save(world, f"file://{tmp_path}/w")
    both = world.together(cities.load(spark, "t", f"file://{tmp_path}/w"))
    assert both.edges.count() == 2 * world.edges.count() and areas.count() == 0
    asked = spark.createDataFrame([(1, 5, 3, None, None)], "query long, src long, dst long, banned array<long>, banned_road string")
    assert roads.shortest(asked, world.edges).first()["path"] in ([5, 1, 3], [5, 4, 3])


def test_projection_and_condition_reach_the_scan(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    spark.range(10).selectExpr("id", "id % 2 as country", "'x' as name", "'y' as other").write.parquet(path)
    rows = files.places(spark, path, ["id", "name", "gone"], F.col("country") == 1)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.columns == ["id", "name"] and rows.count() == 5 and "EqualTo(country,1)" in plan and "other" not in plan
    assert files.listed(spark, path, ".parquet") and files.listed(spark, path + "-gone") == [] and files.changed(spark, path + "-gone") == -1
    assert files.parquet_or_empty(spark, path + "-gone", "id long").count() == 0 and files.of_cities(spark.read.parquet, {"a": path + "-gone"}, spark) is None


def test_kept_is_built_anew_for_newer_input(spark, tmp_path):
    source, path = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    spark.range(3).write.parquet(source)
    assert files.kept(spark, path, [source], lambda: spark.read.parquet(source)).count() == 3
    time.sleep(1.1)
    spark.range(5).write.mode("overwrite").parquet(source)
    assert files.kept(spark, path, [source], lambda: spark.read.parquet(source)).count() == 5


def test_sinks(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    sinks.parquet(spark.range(10), path)
    sinks.without(spark, path, spark.range(0, 10, 2), "id")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3, 5, 7, 9] and [p.name for p in tmp_path.iterdir()] == ["t"]
    sinks.results(spark, {"a": "é"}, f"{path}.json")
    assert "é" in (tmp_path / "t.json").read_text()
    assert settled(spark.range(3)).count() == 3 and new_path(spark, "a") != new_path(spark, "a")


def test_generator_retries(spark):
    state = {"n": 0}

    def call(prompt):
        state["n"] += 1
        if state["n"] < 3:
            raise generation.Busy("429") if state["n"] == 1 else ValueError("bad")
        return prompt

    assert generation.with_retries(call, "p", wait=0.0) == ("p", None) and state["n"] == 3

    def never(prompt):
        raise generation.Busy("503")

    assert generation.with_retries(never, "p", tries=2, wait=0.0) == (None, "busy: 503")
    rows = spark.range(300).selectExpr("cast(id as string) as id", "concat('p', id) as prompt").coalesce(1)
    got = generation.replies(rows, lambda p: p.upper() if not p.endswith("7") else None.x, threads=3, tries=1).collect()
    assert [r["id"] for r in got] == [str(i) for i in range(300)] and all(r["reply"] == f"P{r['id']}" if not r["id"].endswith("7") else r["reply"] is None and "AttributeError" in r["error"] for r in got)


@pytest.mark.parametrize("reply, n", [(None, 0), ("", 0), ("[", 0), ("{}", 0), ("[]", 0), ('[1, "{}", null, [], {}]', 1), ('[{"input": 5, "output": {"a": 1}, "places_used": [1, null, "x"]}]', 1)])
def test_replies_are_not_trusted(spark, reply, n):
    rows = generation.reply_rows(spark.createDataFrame([("a", reply)], "id string, reply string")).collect()
    assert len(rows) == n and (not n or rows[0]["input"] in (None, "5"))


def test_enough_scenarios_numbered_without_gaps(spark):
    world, areas = city(spark, SF)
    rows = scenarios.of_cities(spark, {"grid": (world, areas)}, 12, ["nearby"]).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["id"])] == [f"grid_{i:05d}" for i in range(12)] and {r["city"] for r in rows} == {"Grid"}


def test_strong_parts_of_cities(spark):
    e = fixture(spark, SF, "edges").select("src", "dst")
    two = e.withColumn("city", F.lit("a")).unionByName(e.where("src < 40 and dst < 40").withColumn("city", F.lit("b")))
    n = {r["city"]: r["n"] for r in roads.largest_strong_part(two, "city").groupBy("city").agg(F.count("*").alias("n")).collect()}
    assert n["a"] == 149 and 0 < n["b"] <= 40


def test_diversify_and_sides():
    assert walk.diversify(["Bank A", "Bank A", "Market", "Hotel"], [0.0, 1.0, 2.0, 2.0001], [0.0, 1.0, 2.0, 2.0001]) == [0, 2]
    assert list(pbf.numbers(bytes([1, 2, 3]), True, True)) == [-1, 0, -2] and list(pbf.numbers(b"")) == []
