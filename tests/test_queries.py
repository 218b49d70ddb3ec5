import compare
import pytest

from trailhead.plans import files, guidance, making  # noqa: F401  # they register their queries
from trailhead.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    assert compare.same(spark, name, QUERIES[name], ORACLE[name], SF)


def test_strong_part(spark):
    assert QUERIES["largest_scc"](spark, SF).count() == 149


def test_strong_parts_of_arrays():
    import random
    import tracemalloc

    import numpy as np

    from trailhead.operators import roads

    r = random.Random(2)
    for n in (1, 2, 5, 9, 14):
        for _ in range(40):
            edges = [(r.randrange(n) * 7, r.randrange(n) * 7) for _ in range(r.randrange(1, 2 * n + 1))]
            nodes = sorted({x for e in edges for x in e})
            ahead = {x: {x} for x in nodes}
            for _ in nodes:
                for a, b in edges:
                    ahead[a] |= ahead[b]
            parts = {frozenset(y for y in nodes if y in ahead[x] and x in ahead[y]) for x in nodes}
            want = max(parts, key=lambda p: (len(p), -min(p)))
            assert roads.strong_part(*np.array(edges, np.int64).T).tolist() == sorted(want)
    ring = np.arange(200_000, dtype=np.int64)
    tracemalloc.start()
    assert len(roads.strong_part(ring, np.roll(ring, 1))) == len(ring)
    assert tracemalloc.get_traced_memory()[1] < 90 * len(ring)  # bytes; lists and sets took several times as much
    tracemalloc.stop()


def test_routes_match_relaxation(spark):
    from trailhead.operators import roads
    from trailhead.plans.fixtures import fixture

    rows = fixture(spark, SF, "edges").withColumnRenamed("len_dm", "metres")
    edges = rows.collect()
    best = {0: 0}
    for _ in range(200):
        for e in edges:
            if e["src"] in best:
                best[e["dst"]] = min(best.get(e["dst"], 1 << 60), best[e["src"]] + e["metres"])
    asked = spark.range(150).selectExpr("id as query", "0L as src", "id as dst", "cast(null as array<bigint>) as banned", "cast(null as string) as banned_road")
    asked = asked.unionByName(asked.selectExpr("query + 1000 as query", "src", "dst", "array(0L) as banned", "banned_road")).unionByName(asked.selectExpr("query + 2000 as query", "999L as src", "dst", "banned", "banned_road"))
    found = {r["query"]: r for r in roads.shortest(asked, rows).collect()}
    assert len(found) == 450 and all(found[q]["path"] is None and found[q]["metres"] is None for q in range(1000, 2150) if q in found)
    length = {(e["src"], e["dst"]): e["metres"] for e in edges}
    for q in range(150):
        path = found[q]["path"]
        assert found[q]["metres"] == best.get(q)
        assert path is None or (path[0], path[-1]) == (0, q) and sum(length[x] for x in zip(path, path[1:], strict=False)) == best[q]


@pytest.mark.parametrize("name", ["shortest_path_length", "avoid_nodes_length", "avoid_road_length"])
def test_routing_sends_no_graph_through_the_driver(spark, monkeypatch, name):
    from pyspark import SparkContext
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(*_, **__):
        raise AssertionError("the graph goes through the driver")

    with monkeypatch.context() as m:
        m.setattr(DataFrame, "toPandas", refused)
        m.setattr(SparkContext, "broadcast", refused)
        rows = QUERIES[name](spark, SF)
        assert rows.columns == ["query", "dm"] and rows.count() > 1000


def test_one_search_serves_many_batches(spark):
    from trailhead.operators import roads

    edges = spark.createDataFrame([(1, 2, 1.0, "A"), (2, 3, 1.0, "B"), (1, 4, 1.0, "A"), (4, 3, 1.0, "C"), (3, 5, 2.0, None)], "src long, dst long, metres double, name string")
    asked = spark.createDataFrame([(1, 1, 5, None, None), (2, 1, 5, [2], None), (3, 1, 5, None, "A"), (4, 9, 9, None, None), (5, 9, 9, [9], None), (6, 1, 7, None, None), (7, 1, 1, [5], None), (8, 1, 5, [5], None)], "query long, src long, dst long, banned array<bigint>, banned_road string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = {r["query"]: (r["metres"], r["path"]) for r in roads.shortest(asked, edges).collect()}
        lengths = {r["query"]: r["metres"] for r in roads.shortest(asked, edges, paths=False).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {1: (4.0, [1, 2, 3, 5]), 2: (4.0, [1, 4, 3, 5]), 3: (None, None), 4: (0.0, [9]), 5: (None, None), 6: (None, None), 7: (0.0, [1]), 8: (None, None)}
    assert lengths == {q: m for q, (m, _) in got.items()}
    assert roads.shortest(asked, edges.where("false")).where("metres is not null").count() == 2
