"""Scores of answers against scenarios, place deduplication by name and distance, release counts and card."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailhead.functions import facts, fuzzy
from trailhead.functions import scalar as S
from trailhead.operators import alike, spatial


def scored(answers: DataFrame, scenarios: DataFrame) -> DataFrame:
    """id, split, task, found, why, precision, recall, names_dest of answers (id, split, task, input, output).

    An answer whose scenario is missing counts in ``n`` and scores nothing.  Recall is said roads over roads, so it may pass 1."""
    rows = answers.select("id", "split", F.col("task").alias("asked"), "input", "output").join(facts.with_facts(scenarios.drop("split")).withColumn("found", F.lit(True)), "id", "left")
    none = F.array().cast("array<string>")
    routes = F.array_distinct(F.coalesce(F.transform(F.filter("steps", lambda s: ~s["generic"]), lambda s: S.plain(s["road"])), none))
    said = F.array_distinct(F.transform(facts.road_names(F.coalesce("output", F.lit(""))), S.plain))
    rows = rows.withColumns({"routes": routes, "said": said, "why": facts.reason(F.col("input"), F.col("output"), none)})
    right = F.size(F.filter("said", lambda x: F.exists("routes", lambda r: r.contains(x) | x.contains(r))))
    share = lambda of: F.when(F.size(of) > 0, right / F.size(of)).otherwise(1.0)
    dest = F.coalesce(F.contains(S.plain(F.coalesce("output", F.lit(""))), S.plain(F.col("end.name"))), F.lit(False))
    only = lambda c: F.when(F.col("found"), c)
    return rows.select("id", "split", F.col("asked").alias("task"), F.coalesce("found", F.lit(False)).alias("found"), only(F.col("why")).alias("why"), only(share("said")).alias("precision"), only(share("routes")).alias("recall"), only(dest).alias("names_dest"))


def metrics(scores: DataFrame) -> DataFrame:
    """split, n, pass, road_precision, road_recall, names_dest, fail_<reason>: sums over n, to three places."""
    share = lambda c, name: F.bround(F.coalesce(F.sum(c), F.lit(0)) / F.count("*"), 3).alias(name)
    one = lambda c: F.when(F.col("found") & c, 1.0).otherwise(0.0)
    fails = [share(one(F.col("why") == r), f"fail_{r}") for r in facts.REASONS]
    return scores.groupBy("split").agg(F.count("*").alias("n"), share(one(F.col("why").isNull()), "pass"), share("precision", "road_precision"), share("recall", "road_recall"), share(one(F.col("names_dest")), "names_dest"), *fails)


def task_metrics(scores: DataFrame) -> DataFrame:
    return scores.where("found").groupBy("split", "task").agg(F.count("*").alias("n"), F.bround(F.avg(F.col("why").isNull().cast("double")), 2).alias("pass"))


def not_on_map(places: DataFrame, known: DataFrame, key: str = "id", radius: float = 150.0, least: float = 85.0) -> DataFrame:
    """Places (key, name, lat, lon) with no known landmark (name, lat, lon) nearer than ``radius`` and alike by name."""
    other = known.select(F.col("name").alias("known"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    close = spatial.within(places.select(key, F.lower("name").alias("low"), "lat", "lon"), other, radius * 1.1)
    # Fixed value: 0.99 for the cosine of the latitude
    dy, dx = (F.col("lat") - F.col("p_lat")) * 111000.0, (F.col("lon") - F.col("p_lon")) * 111000.0 * 0.99
    close = close.where(F.sqrt(dy * dy + dx * dx) < radius)
    same = close.where(fuzzy.token_set_ratio(F.col("low"), F.lower("known")) >= least).select(key).distinct()
    return places.join(same, key, "left_anti")


def accept_in_order(places: DataFrame, order: str, least: float = 80.0) -> DataFrame:
    """Of a city's places (city, name, lat, lon, order) those that are no repeat of an earlier accepted one: the same name, or
    within 0.0012 degrees and alike by name.  One task a city; only neighbouring cells of the accepted are compared."""
    schema = places.schema

    def run(frame):
        import re

        cells: dict[tuple[int, int], list[tuple[float, float, str]]] = {}
        names, kept, side = set(), [], 0.0012
        frame = frame.sort_values(order, kind="stable")
        for at, (name, lat, lon) in enumerate(zip(frame["name"], frame["lat"], frame["lon"], strict=True)):
            low = name.lower()
            if low in names:
                continue
            short, r, c = re.sub(r"\(.*?\)", "", low), int(lat // side), int(lon // side)
            near = (x for i in (-1, 0, 1) for j in (-1, 0, 1) for x in cells.get((r + i, c + j), ()))
            if any(abs(lat - a) < side and abs(lon - o) < side and fuzzy.partial_token_set_score(short, n) >= least for a, o, n in near):
                continue
            names.add(low)
            cells.setdefault((r, c), []).append((lat, lon, short))
            kept.append(at)
        return frame.iloc[kept]

    return places.groupBy("city").applyInPandas(run, schema)


def verdicts(claims: DataFrame, landmarks: DataFrame, least: float = 90.0) -> DataFrame:
    """claim, verdict, likeness, metres of claimed landmarks (claim, name, lat, lon of the turn): the landmark most alike by name
    and how far it is.  If none is ``least`` alike, likeness and metres are null.  Each different name is looked up once."""
    asked = claims.withColumn("low", F.lower("name"))
    best = alike.most_alike(asked.select("low"), landmarks, least).select("low", "likeness", F.col("lat").alias("k_lat"), F.col("lon").alias("k_lon"))
    rows = asked.join(best, "low", "left").withColumn("m", S.great_circle(F.col("lat"), F.col("lon"), F.col("k_lat"), F.col("k_lon")))
    verdict = F.when(F.col("likeness").isNull(), "NOT IN OSM").when(F.col("m") <= 150, "OK").otherwise("REAL BUT FAR")
    return rows.select("claim", verdict.alias("verdict"), "likeness", F.floor("m").alias("metres"))


def release_counts(pairs: DataFrame, rejects: DataFrame) -> DataFrame:
    """kind, value, n: pairs by split, task and city, and the rejected ones by reason; one pass over each table."""
    by = pairs.groupingSets([["split"], ["task"], ["city"]], "split", "task", "city").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 3, "split").when(F.col("g") == 5, "task").otherwise("city")
    bad = rejects.groupBy("reason").agg(F.count("*").alias("n")).select(F.lit("reason").alias("kind"), F.col("reason").alias("value"), "n")
    return by.select(kind.alias("kind"), F.coalesce("split", "task", "city").alias("value"), "n").unionByName(bad)


def card(counts: DataFrame, title: str) -> str:
    """A release's card in Markdown from its counts (tens of rows)."""
    rows = sorted(counts.collect(), key=lambda r: (r["kind"], -r["n"], str(r["value"])))
    total, bad = (sum(r["n"] for r in rows if r["kind"] == k) for k in ("split", "reason"))
    lines = [f"# {title}", "", f"{total:,} pairs; {100 * bad / max(bad + total, 1):.0f} % of those written were rejected.", ""]
    for kind in ("split", "task", "city", "reason"):
        lines += [f"| {kind} | rows |", "|---|---|"] + [f"| {r['value']} | {r['n']:,} |" for r in rows if r["kind"] == kind] + [""]
    return "\n".join(lines)
