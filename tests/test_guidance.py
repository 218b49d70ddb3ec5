import math
import random

import pytest
from pyspark.sql import functions as F

from trailhead.functions import facts, fuzzy, prompts
from trailhead.operators import alike, evaluation, roads, scenarios, walk
from trailhead.plans.fixtures import city, fixture, shaped
from trailhead.plans.fixtures import scenarios as order_scenarios

SF = "/root/testdata/sf0.001"


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_scores():
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc é") for _ in range(rnd.randrange(12))) for _ in "ab")
        assert fuzzy.lcs(a, b) == slow_lcs(a, b)
    assert fuzzy.score("", "") == 100 and fuzzy.score("a", "") == 0
    assert fuzzy.token_set_score("new market", "market new new old") == 100 and fuzzy.token_set_score("", "x") == 0
    assert fuzzy.partial_token_set_score("kumasi market", "old market") == 100
    assert fuzzy.partial_token_set_score("abcd", "zzabcdzz") == 100 and fuzzy.partial_token_set_score("abcd", "abxd") == 75


def test_ratio_of_columns(spark):
    rows = [("ring road", "ring rd"), ("", ""), ("", "x"), ("abc", "xyz"), ("same", "same"), ("naïve", "naive")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", fuzzy.ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert all(math.isclose(r["r"], fuzzy.score(r["a"], r["b"])) for r in got)


def test_merge_runs():
    assert walk.merge_runs([100.0, 500.0], [True, True], ["A", "B"]) == [[0, 1, 1]]
    assert walk.merge_runs([200.0], [False], ["a side street"]) == [[0, 0, 0]]
    assert walk.merge_runs([500.0, 200.0, 500.0], [True, False, True], ["A", "x", "A"]) == [[0, 2, 0]]  # the same road again is joined
    assert len(walk.merge_runs([400.0] * 8, [True] * 8, list("ABCDEFGH"))) == walk.MOST_STEPS
    assert walk.merge_runs([150.0, 290.0], [True, False], ["A", "x"]) == [[0, 1, 0]]  # the name needs 30 % of the whole
    assert walk.merge_runs([150.0, 900.0, 100.0], [True, False, True], ["A", "x", "B"]) == [[0, 0, 0], [1, 2, 1]]


def bearing(a, b):
    t, x, y = math.radians(b[1] - a[1]), math.radians(a[0]), math.radians(b[0])
    return (math.degrees(math.atan2(math.sin(t) * math.cos(y), math.cos(x) * math.sin(y) - math.sin(x) * math.cos(y) * math.cos(t))) + 360) % 360


def slow_steps(path, at, edge, near, places):
    """Steps of one path, node by node."""
    hops = list(zip(path, path[1:], strict=False))
    label = {"tertiary": "a connecting road", "residential": "a side street"}
    named = [bool(edge[h][1]) for h in hops]
    name = [edge[h][1] or label[edge[h][2]] for h in hops]
    groups = [[0]]
    for i in range(1, len(hops)):
        groups[-1].append(i) if name[i] == name[i - 1] else groups.append([i])
    merged = walk.merge_runs([sum(edge[hops[i]][0] for i in g) for g in groups], [named[g[0]] for g in groups], [name[g[0]] for g in groups])

    def sides(pos):
        if not 0 < pos < len(path) - 1:
            return []
        inward, out = bearing(at[path[pos - 1]], at[path[pos]]), []
        for m in near[path[pos]] - {path[pos - 1], path[pos + 1]}:
            d = (bearing(at[path[pos]], at[m]) - inward + 540) % 360 - 180
            out += ["right"] if 25 < d < 155 else ["left"] if -155 < d < -25 else []
        return out

    def seen(node, radius, most, least):
        here, rows = at[node], []
        for p in places:
            d = math.hypot((p["lat"] - here[0]) * 111000, (p["lon"] - here[1]) * 111000 * math.cos(math.radians(here[0])))
            rows.append((d, p["id"], p))
        return sorted(((-p["imp"], d, i, p["name"]) for d, i, p in sorted(rows, key=lambda r: r[:2])[:most] if d <= radius and p["imp"] >= least), key=lambda r: r[:3])

    out, used = [], set()
    for k, (first, last, who) in enumerate(merged):
        a, b = groups[first][0], groups[last][-1] + 1
        step = {"road": name[groups[who][0]], "start_node": path[a], "end_node": path[b], "turn": None, "turn_ordinal": None}
        mine = [x[3] for x in seen(path[b], 200, 25, 2) if x[3] not in used][:2]
        used |= set(mine)
        step["landmarks_at_end"] = mine
        if k == 0:
            step["side_roads_passed"] = sum(len(sides(i)) for i in range(1, b))
        else:
            d = (bearing(at[path[a]], at[path[a + 1]]) - bearing(at[path[a - 1]], at[path[a]]) + 540) % 360 - 180
            way = "straight" if abs(d) < 25 else ("slight " if abs(d) < 60 else "sharp " if abs(d) >= 135 else "") + ("right" if d > 0 else "left")
            passed = [s for i in range(before + 1, a + 1) for s in sides(i)]  # noqa: F821
            step |= {"turn": way, "side_roads_passed": len(passed)}
            if way != "straight":
                n = passed.count(way.split()[-1]) + 1
                step["turn_ordinal"] = n if n <= 3 else None
        before = a  # noqa: F841
        out.append(step)
    return out


def test_steps_match_a_walk_node_by_node(spark):
    world, _ = city(spark, SF)
    at = {r["node"]: (r["lat"], r["lon"]) for r in world.nodes.collect()}
    edge = {(r["src"], r["dst"]): (r["metres"], r["name"], r["kind"]) for r in world.edges.collect()}
    near = {n: set() for n in at}
    for a, b in edge:
        near[a].add(b)
        near[b].add(a)
    places = [r.asDict() for r in world.landmarks.collect()]
    asked = world.nodes.select(F.col("node").alias("query"), F.lit(3).cast("long").alias("src"), F.col("node").alias("dst"), F.lit(None).cast("array<bigint>").alias("banned"), F.lit(None).cast("string").alias("banned_road"))
    paths = roads.shortest(asked, world.edges).where("path is not null").withColumn("exclude", F.lit(None).cast("array<string>"))
    found = {r["query"]: r["path"] for r in paths.collect()}
    got = walk.describe(paths, world).collect()
    assert len(got) == len(found) - 1  # the path of one node has no steps
    for row in got:
        want = slow_steps(found[row["query"]], at, edge, near, places)
        assert [{k: s[k] for k in w} for s, w in zip(row["steps"], want, strict=True)] == want
        for s in row["steps"][1:]:
            assert len(s["turn_lms"]) <= 2


def test_walks_send_no_graph_through_the_driver(spark, monkeypatch):
    from pyspark import SparkContext
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(*_, **__):
        raise AssertionError("the graph goes through the driver")

    world, areas = city(spark, SF)
    asked = world.nodes.select(F.col("node").alias("query"), F.lit(3).cast("long").alias("src"), F.col("node").alias("dst"), F.when(F.col("node") % 2 == 0, F.array(F.lit(44).cast("long"))).alias("banned"), F.lit(None).cast("string").alias("banned_road"), F.array(F.lit("Bank 3")).alias("exclude"))
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "toPandas", refused)
        m.setattr(SparkContext, "broadcast", refused)
        routed = walk.describe_routes(asked, world)
        paths = roads.shortest(asked, world.edges).where("path is not null").withColumn("exclude", F.array(F.lit("Bank 3")))
        given = walk.describe(paths, world)
        assert scenarios.build(spark, world, areas, 40).count() > 5
    assert sorted(routed.collect()) == sorted(given.collect()) and given.count() > 100


@pytest.mark.parametrize("name", ["knn_landmarks", "nearest_node_snap", "radius_nodes", "names_not_taken"])
def test_neighbour_cells_are_not_broadcast(spark, name):
    from trailhead.plans import files  # noqa: F401  # it registers queries
    from trailhead.plans.queries import QUERIES

    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_r" in plan


def test_either_side_may_enter_its_neighbours(spark):
    from trailhead.operators import spatial

    places = fixture(spark, SF, "vertices").select("node", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    points = fixture(spark, SF, "landmarks").select("id", "lat", "lon")
    one, other = (sorted(spatial.within(points, places, 333.0, few_points=few).select("id", "node", "d").collect()) for few in (False, True))
    assert one == other and len(one) > 50


def test_scenarios_keep_their_rules(spark):
    world, areas = city(spark, SF)
    rows = scenarios.build(spark, world, areas, 400).collect()
    assert len({r["id"] for r in rows}) == len(rows) and {"route", "short_hop", "gps_start", "nearby"} <= {r["task"] for r in rows}
    for r in rows:
        if r["task"] == "nearby":
            assert 3 <= len(r["nearby"]) <= 6 and r["end"] is None and [x["dist_m"] for x in r["nearby"]] == sorted(x["dist_m"] for x in r["nearby"])
            continue
        assert len(r["steps"] or []) <= walk.MOST_STEPS and r["route_km"] <= 3 * r["straight_km"] + 0.9
        if r["task"] == "avoid_road":
            assert r["avoid"]["name"] not in [s["road"] for s in r["steps"]]
        if r["task"] == "connects" and r["on_route"]:
            assert r["question_landmark"] in [n for s in r["steps"] for n in s["landmarks_at_end"]]
        assert not {r["start"]["name"], r["end"]["name"]} & {n for s in r["steps"] or [] for n in s["landmarks_at_end"]}


ASK, GOOD = "How do I get to the school?", "Follow Ring Road, then turn left at the bank. The school is on your right."
CASES = [
    (ASK, GOOD, [], None), ("", GOOD, [], "empty"), (None, None, None, "empty"), ("a " * 71, GOOD, [], "input_long"), (ASK, "a " * 116, [], "output_long"), (ASK, GOOD, ["Golden Crown Road"], "road_declared"),
    (ASK, GOOD, ["Ring Roat Road", "Ring Raod", "Golden Bank", ""], "road_declared"), (ASK, GOOD, ["Ring Rod Road"], "road_declared"), (ASK, GOOD, ["Rings Road"], None), (ASK, "Take Golden Crown Road.", [], "road_undeclared"), (ASK, "Go on for 2 km.", [], "has_distance"), (ASK, "At 6.5812 stop.", [], "coord_in_output"),
    ("I am at 6.5812", GOOD, [], "coord_in_input"), (ASK, "Take the third left.", [], "ordinal"), (ASK, "Take the 2nd left.", [], "ordinal"), (ASK, "Take the second left.", [], None), (ASK, "Take the fifth turn.", [], "ordinal"),
    (ASK, "Head west.", [], "direction"), (ASK, "Head north east, then east.", [], None), (ASK, "Pass North Gate.", [], None), (ASK, "Go along Old Town Lane.", [], "uses_avoided"), (ASK, "Follow ring road past Old Town Lane", [], "uses_avoided"),
]


@pytest.fixture(scope="module")
def one_scenario(spark):
    row = """{"id":"s1","task":"avoid_road","city":"Grid","start":{"name":"North Gate","area":"Adum","type":"market"},"end":{"name":"Hill School","area":"Adum","type":"school"},"bearing":"north-east","dest_side":"right",
      "steps":[{"road":"Ring Road","generic":false,"heading":"north-east","dist_m":500},{"road":"a side street","generic":true,"heading":"north","dist_m":300,"turn":"slight left","turn_ordinal":2}],"avoid":{"kind":"road","name":"Old Town Lane"}}"""
    from trailhead.plans.fixtures import SCENARIO

    return spark.createDataFrame([(row,)], "j string").select(F.from_json("j", SCENARIO).alias("s")).select("s.*")


def test_registered_task(spark):
    world, areas = city(spark, SF)

    @scenarios.task("where_is", 5)
    def where_is(world, areas, drawn, pools):
        asked = drawn.withColumn("at", F.floor(scenarios.chance("which") * pools.poi.count())).join(pools.poi, "at")
        start = F.struct("name", "lat", "lon", "area", F.col("cat").alias("type"), F.lit(None).cast(scenarios.SIGHT).alias("near"))
        return asked.select("draw", F.lit(0).alias("part"), "task", start.alias("start"), F.array("name").alias("pair"))

    try:
        rows = scenarios.build(spark, world, areas, 60, ["where_is", "nearby"]).collect()
    finally:
        del scenarios.TASKS["where_is"], scenarios.MAKERS["where_is"]
    names = [r["start"]["name"] for r in rows if r["task"] == "where_is"]
    assert len(names) == len(set(names)) > 5 and {r["task"] for r in rows} == {"where_is", "nearby"} and all(r["split"] and r["id"] for r in rows)


def test_numbering_by_ranges(spark):
    rows = spark.range(0, 500).select(F.xxhash64("id").alias("key"), "id")
    got = scenarios._numbered(rows, "key").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(500)) and [r["key"] for r in got] == sorted(r["key"] for r in got)
    assert scenarios._numbered(rows.where("id < 0"), "key").count() == 0


def test_reasons(spark, one_scenario):
    rows = spark.createDataFrame([(n, *c[:3]) for n, c in enumerate(CASES)], "n int, i string, o string, p array<string>")
    found = facts.with_facts(one_scenario).join(rows, F.lit(True)).select("n", facts.reason(F.col("i"), F.col("o"), F.col("p")).alias("why")).collect()
    assert {r["n"]: r["why"] for r in found} == {n: c[3] for n, c in enumerate(CASES)}


def test_reasons_repeat_no_work(spark, one_scenario):
    rows = facts.with_facts(one_scenario)
    made = rows.select(facts.reason(F.lit(ASK), F.col("end.name"), F.array().cast("array<string>")).alias("why"))._jdf.queryExecution().analyzed().toString().split("\n")[0]
    assert made.count("split(") <= 6  # words of names, phrases and stretches are split once each
    said = [("xNorth Gatewest", "direction"), ("nor North Gate th", None), ("Take Ring Road North Gate Road.", None), ("Take Crown Ring Hill Road.", "road_undeclared"), ("Take Golden Hill Road.", "road_undeclared"), ("Take Hill School Road.", None), ("Take the Road Street.", None)]
    asked = spark.createDataFrame([(n, x[0]) for n, x in enumerate(said)], "n int, o string")
    got = {r["n"]: r["why"] for r in rows.join(asked, F.lit(True)).select("n", facts.reason(F.lit(ASK), F.col("o"), F.array().cast("array<string>")).alias("why")).collect()}
    assert got == {n: x[1] for n, x in enumerate(said)}


def test_side_needs_a_turn(spark, one_scenario):
    rows = facts.with_facts(one_scenario.withColumn("dest_side", F.lit("ahead")))
    assert rows.select(facts.reason(F.lit(ASK), F.lit("Turn right."), F.array().cast("array<string>"))).first()[0] == "side"


def test_spans_and_facts_text(spark, one_scenario):
    row = one_scenario.select(facts.spans().alias("m"), prompts.facts_text().alias("t"), facts.numbered_turns().alias("n")).first()
    assert sorted(row["m"]) == [300, 500, 800] and row["n"] == ["second left"]
    assert "2. TURN LEFT = the second left turn, onto a side street (generic, unnamed: do not name it). Landmarks at this turn: NONE." in row["t"].split("\n")


def test_reply_reasons(spark, one_scenario):
    near = one_scenario.withColumn("task", F.lit("nearby"))
    ask = lambda text, repeated=False: near.select(facts.reply_reason(F.lit(text), F.lit(None).cast("string"), F.lit(repeated))).first()[0]
    assert ask("GPS please") == "style_leak" and ask("What is near?") == "no_location" and ask("What is near ADUM?") is None and ask("near Adum?", True) == "duplicate"


def test_missing_scenario_counts_in_n(spark):
    answers = spark.createDataFrame([("zz", "a", "route", ASK, GOOD), ("1", "a", "route", ASK, "Turn left.")], "id string, split string, task string, input string, output string")
    row = evaluation.metrics(evaluation.scored(answers, order_scenarios(spark, SF))).first()
    assert row["n"] == 2 and row["pass"] == 0.5 and row["road_precision"] == 0.5


def test_fuzzy_joins_match_all_pairs(spark):
    places = fixture(spark, SF, "landmarks").select(F.lit("c").alias("city"), "id", "name", "lat", "lon")
    rows = places.collect()
    known = [r for r in rows if r["id"] % 2 == 0]
    gap = lambda a, b: math.hypot((a["lat"] - b["lat"]) * 111000, (a["lon"] - b["lon"]) * 111000 * 0.99)
    want = {r["id"] for r in rows if not any(gap(r, k) < 150 and fuzzy.token_set_score(r["name"].lower(), k["name"].lower()) >= 85 for k in known)}
    assert {r["id"] for r in evaluation.not_on_map(places, places.where("id % 2 = 0")).collect()} == want
    claims = [(1, "markt 8", 6.58, -1.75), (2, "Zebra", 6.58, -1.75), (3, "", 6.58, -1.75), (4, rows[0]["name"] + " building", rows[0]["lat"], rows[0]["lon"])]
    for r in evaluation.verdicts(spark.createDataFrame(claims, "claim long, name string, lat double, lon double"), places).collect():
        best = max(fuzzy.token_set_score(claims[r["claim"] - 1][1].lower(), p["name"].lower()) for p in rows)
        assert (r["verdict"] == "NOT IN OSM") == (best < 90)


def test_no_alike_pair_is_missed(spark):
    r = random.Random(5)
    words = ["a", "ab", "bank", "market", "the", "hotel", "école", "hall"]
    name = lambda: " ".join(r.choice(words) if r.random() < 0.6 else "".join(r.choice("abco ") for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 4)))
    known = {name() for _ in range(150)}
    asked = {x[: r.randint(0, 6)] + r.choice("abz") + x[r.randint(0, 6) :] for x in known} | {name() for _ in range(60)}
    frame = lambda rows: spark.createDataFrame([(x,) for x in [*rows, None]], "low string")
    for least in (80.0, 90.0):
        got = [tuple(x) for x in alike.pairs(frame(asked), frame(known), least).collect()]
        assert len(got) == len(set(got)) and set(got) >= {(x, y) for x in asked for y in known if fuzzy.token_set_score(x, y) >= least}
    places = spark.createDataFrame([(7, "Old Bank", 1.0, 1.0), (3, "bank OLD", 2.0, 2.0), (9, None, 0.0, 0.0)], "id long, name string, lat double, lon double")
    claims = spark.createDataFrame([(1, "old bank", 2.0, 2.0), (2, None, 2.0, 2.0), (3, "Zebra", 2.0, 2.0), (4, "Old bank", 1.0, 1.0)], "claim long, name string, lat double, lon double")
    got = {x["claim"]: (x["verdict"], x["likeness"]) for x in evaluation.verdicts(claims, places).collect()}
    assert got == {1: ("OK", 100.0), 2: ("NOT IN OSM", None), 3: ("NOT IN OSM", None), 4: ("REAL BUT FAR", 100.0)}


def test_names_found_by_words_do_not_meet_by_letters(spark, monkeypatch):
    from trailhead.plans import making
    from trailhead.plans.fixtures import fixture as whole

    met = alike._met
    seen = {}
    monkeypatch.setattr(alike, "_met", lambda asked, known, least, letters: seen.setdefault(letters, asked) and met(asked, known, least, letters))
    claims, places = making._claims(spark, SF)
    claims = claims.unionByName(claims.limit(1).selectExpr("-1L as claim", "'the markte no 8' as name", "lat", "lon"))
    got = {r["claim"]: r for r in evaluation.verdicts(claims, places).collect()}
    assert {r["low"] for r in seen[True].collect()} == {"golden gate", "the markte no 8"} and seen[False].count() > 5
    best = max(fuzzy.token_set_score("the markte no 8", p["name"].lower()) for p in places.collect())
    assert (got[-1]["verdict"] == "NOT IN OSM") == (best < 90) and len(got) == whole(spark, SF, "landmarks").count() + 1


def test_nearest_of_many_areas(spark, monkeypatch):
    from trailhead.operators import shipping, spatial

    r = random.Random(8)
    places = [(f"A{i % 90:02d}", round(6.5 + r.random() * 0.2, 3), round(-1.8 + r.random() * 0.2, 3)) for i in range(400)]
    places += [("B1", 6.6, -1.7), ("B0", 6.6, -1.7), ("C", 89.9, 10.0), ("D", 6.55, 179.95)]
    spots = [(i, round(6.4 + r.random() * 0.4, 3), round(-1.9 + r.random() * 0.4, 3)) for i in range(300)] + [(900, 6.6, -1.7), (901, 89.0, -170.0), (902, 6.55, -179.95), (903, None, 1.0)]
    areas = spark.createDataFrame(places, "name string, lat double, lon double")
    points = spark.createDataFrame(spots, "id long, lat double, lon double")
    asked = []
    beside = shipping.beside
    monkeypatch.setattr(shipping, "beside", lambda *a: asked.append(1) or beside(*a))
    got = sorted(spatial.nearest_of_few(points, areas, "id").collect())
    assert asked  # no array of all areas for each point
    monkeypatch.setattr(spatial, "FEW", 1 << 20)
    assert got == sorted(spatial.nearest_of_few(points, areas, "id").collect()) and len(got) == len(spots) and dict(got)[900] == "B0"


def test_accept_in_order(spark):
    rows = [("c", 1, "Big Market", 6.0, 1.0), ("c", 2, "Market (old)", 6.0005, 1.0005), ("c", 3, "Market Hall", 6.01, 1.0), ("c", 4, "big market", 7.0, 1.0), ("c", 5, "Clinic", 6.0, 1.0)]
    got = evaluation.accept_in_order(spark.createDataFrame(rows, "city string, id long, name string, lat double, lon double"), "id").collect()
    assert sorted(r["id"] for r in got) == [1, 3, 5]


def test_card(spark):
    counts = spark.createDataFrame([("split", "train", 9), ("task", "route", 9), ("city", "Accra", 9), ("reason", "side", 1)], "kind string, value string, n long")
    assert "10 % of those written were rejected" in evaluation.card(counts, "T")


def plain_merge(metres, named, roads):
    """The merging rule, step lists rebuilt each time."""
    steps = [(i, i, i, m) for i, m in enumerate(metres)]
    while len(steps) > 1:
        weak = [i for i, (_, _, who, m) in enumerate(steps) if m < (walk.WEAK if named[who] else walk.WEAK_UNNAMED)]
        if weak:
            at = min(weak, key=lambda i: steps[i][3])
        elif len(steps) > walk.MOST_STEPS:
            at = min(range(len(steps)), key=lambda i: (named[steps[i][2]], steps[i][3]))
        else:
            break
        low = max(at - 1, 0)
        two = steps[low : low + 2]
        total = two[0][3] + two[1][3]
        who = max([s for s in two if named[s[2]] and s[3] >= walk.NAME_SHARE * total] or two, key=lambda s: s[3])[2]
        stop = low + 2
        while stop < len(steps) and roads[steps[stop][2]] == roads[who]:
            total += steps[stop][3]
            stop += 1
        steps[low:stop] = [(steps[low][0], steps[stop - 1][1], who, total)]
    return [list(s[:3]) for s in steps]


def test_merge_is_the_plain_rule():
    import random

    rng = random.Random(4)
    for _ in range(1500):
        n = rng.randint(1, 30)
        metres = [float(rng.choice([20, 50, 100, 119, 120, 121, 299, 300, 500, 2000, rng.randint(1, 900)])) for _ in range(n)]
        roads = [rng.choice("abcdefu") for _ in range(n)]
        named = [r != "u" for r in roads]
        assert walk.merge_runs(metres, named, roads) == plain_merge(metres, named, roads)
