"""Queries that have answers written by an injected generator, sample, tally and prepare training rows, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailhead.functions import fuzzy, prompts
from trailhead.operators import evaluation, generation, spatial
from trailhead.plans import guidance  # noqa: F401  # its SQL is used here
from trailhead.plans.fixtures import duck, fixture
from trailhead.plans.fixtures import scenarios as order_scenarios
from trailhead.plans.queries import ORACLE, query
from trailhead.sources import files, sinks
from trailhead.sources.stages import new_path
from trailhead.sources.tables import table
from trailhead.streaming import incremental

L = duck("landmarks")
TEMPLATE = "Write {n} requests and answers for {city} as a JSON array of {{input, output, places_used}}.\nAt most {maxw} words an answer.\nFACTS\n{facts}\nTASK: {task}\nSTYLES\n{styles}"
DESCRIBED = {"route": "Give directions.", "avoid_road": "Give directions that do not use {a}."}
STYLED = {"route": ["casual", "formal", "rushed", "polite", "short", "car", "names"], "avoid_road": ["why not", "tired", "late"]}
DUCK_STYLES = "(select id, list(s order by md5(concat(id, s)), s)[1:5] as styles from (select id, unnest(case when k % 4 = 0 then ['why not','tired','late'] else ['casual','formal','rushed','polite','short','car','names'] end) as s from (select o_orderkey as k, o_orderkey::varchar as id from orders)) group by id)"


@query(f"""with f as ({ORACLE['render_facts']}) select id, concat('Write ', len(styles), ' requests and answers for Grid as a JSON array of {{input, output, places_used}}.', chr(10), 'At most ', case when id::bigint % 4 = 0 then 86 else 82 end, ' words an answer.', chr(10), 'FACTS', chr(10), facts, chr(10),
  'TASK: ', case when id::bigint % 4 = 0 then 'Give directions that do not use Ring Road.' else 'Give directions.' end, chr(10), 'STYLES', chr(10), array_to_string(list_transform(styles, lambda s, i: concat('  ', i, '. ', s)), chr(10))) as prompt from f join {DUCK_STYLES} using (id)""")
def generator_prompts(spark, d):
    return generation.with_prompts(order_scenarios(spark, d), TEMPLATE, DESCRIBED, STYLED).select("id", "prompt")


def written_by_rule(prompt: str) -> str:
    """A generator for tests: its reply follows from the prompt, and holds elements that are no objects, repeats and faults."""
    import json
    import re

    m = int(re.search(r"School (\d+)", prompt)[1])
    if m == 12:
        return "not JSON"
    if m == 11:
        return json.dumps({"input": "x", "output": "y"})
    good = {"input": f"How do I get to School {m}?", "output": "Go along Row Road and keep going.", "places_used": ["Row Road", None]}
    rows = [good, 5, "text", None, dict(good, output="Go north-west."), dict(good, input=f" how do i get to school {m}? "), dict(good, input="formal: hello"), {"input": "Hi", "output": ""}, {"output": "no input"}, dict(good, input="Where is it?", places_used="none"), ["x"]]
    return json.dumps(rows)


@query("""with s as (select o_orderkey as k, o_orderkey % 13 as m, case when o_orderkey % 4 = 0 then 'avoid_road' else 'route' end as task from orders)
  select k::varchar as id, task, pos, input, output, reason, concat('Market ', k % 11) as start, concat('School ', m) as "end" from s, lateral (select * from (values (0, concat('How do I get to School ', m, '?'), 'Go along Row Road and keep going.', null), (4, concat('How do I get to School ', m, '?'), 'Go north-west.', 'direction'),
    (5, concat(' how do i get to school ', m, '? '), 'Go along Row Road and keep going.', 'duplicate'), (6, 'formal: hello', 'Go along Row Road and keep going.', 'style_leak'), (7, 'Hi', '', 'empty'), (8, null, 'no input', 'empty'), (9, 'Where is it?', 'Go along Row Road and keep going.', null)) as v(pos, input, output, reason)) where m < 11""")
def generated_rows(spark, d):
    """Two runs of the generator over all scenarios: the first stops at a limit, the second writes what is left and no more."""
    path, calls = new_path(spark, "generated"), {"threads": 4, "wait": 0.0}
    s = order_scenarios(spark, d)
    for limit in (100, None):
        generation.run(s, written_by_rule, f"{path}/pairs", f"{path}/rejects", TEMPLATE, DESCRIBED, STYLED, limit, **calls)
    schema = "id string, task string, pos int, input string, output string, reason string, start string, end string"
    return files.json_lines(spark, f"{path}/pairs", schema).unionByName(files.json_lines(spark, f"{path}/rejects", schema))


@query("select o_orderkey as id from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity < 10 union select l_orderkey from lineitem where l_returnflag = 'R')")
def resume_union(spark, d):
    rows = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "id")
    done = rows.where("l_quantity < 10").select("id").union(rows.where("l_returnflag = 'R'").select("id"))
    return incremental.not_done(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), done, "id")


@query("""select id, split, 'each' as kind from (select o_orderkey as id, o_orderstatus as split, row_number() over (partition by o_orderstatus order by md5(concat('1|', o_orderkey)), o_orderkey) as n from orders) where n <= 40
  union all select * from (select o_orderkey, o_orderstatus, 'all' from orders order by md5(concat('11|', o_orderkey)), o_orderkey limit 60)""")
def seeded_rows(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("split"))
    return generation.seeded_head(rows, 40, "id", 1, "split").withColumn("kind", F.lit("each")).unionByName(generation.seeded_head(rows, 60, "id", 11).withColumn("kind", F.lit("all")))


@query("select k::varchar as id from (select o_orderkey as k from orders) where k % 4 <> 0 and k % 6 between 2 and 4")
def probe_scenarios(spark, d):
    """Scenarios worth probing, of those whose id has answers; the routes' lengths follow from the order's number."""
    k = F.col("id").cast("long")
    rows = order_scenarios(spark, d).withColumn("route_km", (k % 6).cast("double"))
    answered = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    return generation.worth_probing(rows).join(answered, "id", "left_semi").select("id")


@query("select c.k as claim, case when c.k % 5 = 0 then 'NOT IN OSM' when c.k % 3 = 0 then 'REAL BUT FAR' else 'OK' end as verdict from (select s_suppkey as k from supplier) c")
def verify_verdicts(spark, d):
    """Claimed landmarks: their own name with an article, at their own place or 445 m off, or a name that no landmark is like."""
    return evaluation.verdicts(*_claims(spark, d)).select("claim", "verdict")


def _claims(spark, d):
    places = fixture(spark, d, "landmarks").select("id", F.concat(F.split("name", " ")[0], F.lit(" no "), F.col("id").cast("string")).alias("name"), "lat", "lon")
    claims = places.select(F.col("id").alias("claim"), F.when(F.col("id") % 5 == 0, "Golden Gate").otherwise(F.concat(F.lit("the "), "name")).alias("name"), (F.col("lat") + F.when(F.col("id") % 3 == 0, 0.004).otherwise(0.0)).alias("lat"), "lon")
    return claims, places


@query(f"with v as ({ORACLE['verify_verdicts']}) select verdict, count(*) as n, round_even(count(*) * 1.0 / (select count(*) from v), 3) as share from v group by verdict")
def verdict_tallies(spark, d):
    return generation.verdict_tallies(evaluation.verdicts(*_claims(spark, d)))


@query("select l_orderkey % 4 as grp, count(*) as n, round_even(avg(s), 1) as mean_steps, max(s) as most_steps, sum(g)::bigint as generic, sum(s)::bigint as steps from (select l_orderkey, count(*) as s, count(*) filter (l_returnflag = 'R') as g from lineitem group by l_orderkey) group by 1")
def steps_counts(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_returnflag") == "R").alias("generic"))).alias("steps"))
    rows = rows.unionByName(spark.sql("select 0L as l_orderkey, cast(array() as array<struct<generic:boolean>>) as steps"))
    return generation.steps_summary(rows.withColumn("grp", F.col("l_orderkey") % 4), "grp")


@query("select o_orderkey::varchar as id from orders where o_orderkey % 5 = 1 or (o_orderkey % 2 = 1 and o_orderkey % 5 not in (0, 2))")
def scenarios_to_clean(spark, d):
    """Of scenarios of which every other is ``nearby``: leaked style, or a request that names neither the start nor its latitude."""
    k = F.col("o_orderkey")
    said = F.array(F.lit("Is there a bank by market "), F.lit("short: where to"), F.lit("What is at 6.5812"), F.lit("Is GPS needed"), F.lit("What is near me"))
    pairs = table(spark, d, "orders").select(k.cast("string").alias("id"), F.when(k % 5 == 0, F.concat(said[0], (k % 11).cast("string"))).otherwise(F.get(said, (k % 5).cast("int"))).alias("input"))
    rows = order_scenarios(spark, d).withColumn("task", F.when(F.col("id").cast("long") % 2 == 1, "nearby").otherwise("route"))
    return generation.to_write_anew(pairs, rows.withColumn("start", F.struct("start.name", F.lit(6.58123).alias("lat"))))


@query("""select id, concat_ws(chr(10), concat('1. Start by heading north on Row Road ', k % 9, '.'),
    concat('2. ', case when k % 3 = 2 then 'KEEP STRAIGHT onto a side street, passing 0 small side roads.' else concat(case when k % 3 = 0 then 'TURN LEFT (' else 'TURN RIGHT (' end,
      case when k % 4 = 0 then concat(side, ' turn (many small roads before it, so do NOT count them)') else concat(['first','second','third'][k % 4], ' ', side, ' turn') end, ') onto a side street.') end,
      case when k % 2 = 0 then concat(' GRAPH landmark at this junction: Bank ', k % 7, ' (on your right).') else ' GRAPH landmark at this junction: NONE.' end)) as skeleton
  from (select o_orderkey as k, o_orderkey::varchar as id, case when o_orderkey % 3 = 0 then 'left' else 'right' end as side from orders)""")
def skeleton_lines(spark, d):
    return order_scenarios(spark, d).select("id", prompts.skeleton_text().alias("skeleton"))


@query("""select conv_id, concat('<|im_start|>system', chr(10), 'Be brief.<|im_end|>', chr(10), string_agg(concat('<|im_start|>', role, chr(10), coalesce(text, ''), '<|im_end|>', chr(10)), '' order by turn, role, coalesce(text, '')),
  case when conv_id % 2 = 0 then concat('<|im_start|>assistant', chr(10), case when conv_id % 4 = 0 then concat('<think>', chr(10), chr(10), '</think>', chr(10), chr(10)) else '' end) else '' end) as text from conversations group by conv_id""")
def chat_rendered(spark, d):
    one = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content"))
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("m"))
    told = F.concat(F.array(F.struct(F.lit("system").alias("role"), F.lit("Be brief.").alias("content"))), F.transform("m", lambda x: F.struct(x["role"], x["content"])))
    rows = rows.withColumn("chat", told)
    k = F.col("conv_id")
    text = F.when(k % 4 == 0, prompts.chat_text(F.col("chat"), True)).when(k % 2 == 0, prompts.chat_text(F.col("chat"), True, thinking=None)).otherwise(prompts.chat_text(F.col("chat"), False))
    return rows.select("conv_id", text.alias("text"))


@query("""with t as (select o_orderkey as k, o_orderkey % 20 as batch, o_orderkey % 7 + 1 as p, o_orderkey % 9 as a from orders), n as (select *, least(p + a, 10) as n from t)
  select k, n as ids, sum(n) over (partition by batch) as batch_ids, max(n) over (partition by batch) as width, least(p, 10) + (max(n) over (partition by batch) - n) as not_trained, greatest(n - p, 0) as trained, 5 * least(p, 10) + 6 * greatest(n - p, 0) as id_sum, round_even(avg(n) over (), 1) as mean_ids from n""")
def labels_and_padding(spark, d):
    """Prompt and answer ids cut to ten, labels over the answer only, batches filled up to their longest row."""
    from pyspark.sql import Window

    k = F.col("o_orderkey")
    ids = lambda x, n: F.array_repeat(F.lit(x), n.cast("int"))
    rows = table(spark, d, "orders").select(k.alias("k"), (k % 20).alias("batch"), prompts.loss_labels(ids(5, k % 7 + 1), ids(6, k % 9), 10).alias("x")).select("k", "batch", "x.*")
    made = prompts.padded(rows, "batch")
    own = F.aggregate("mask", F.lit(0), lambda a, b: a + b)
    count = lambda c, f: F.size(F.filter(c, f)).cast("long")
    found = made.select(
        "k", "batch", own.cast("long").alias("ids"), F.size("ids").cast("long").alias("width"), count("labels", lambda x: x == -100).alias("not_trained"), count("labels", lambda x: x != -100).alias("trained"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, b: a + b).alias("id_sum"),
    )
    mean_ids = found.agg(F.bround(F.avg("ids"), 1).alias("mean_ids"))
    return found.withColumn("batch_ids", F.sum("ids").over(Window.partitionBy("batch"))).drop("batch").join(F.broadcast(mean_ids), F.lit(True))


@query("select n_name as name, n_nationkey % 4 <> 0 as ok, case when n_nationkey % 4 = 0 then 'ValueError: no' else (n_nationkey * 2)::varchar end as outcome from nation")
def sweep_log(spark, d):
    settings = [{"name": r["n_name"], "k": r["n_nationkey"]} for r in table(spark, d, "nation").collect()]

    def run(s):
        if s["k"] % 4 == 0:
            raise ValueError("no")
        return s["k"] * 2

    return generation.sweep(spark, settings, run)


@query("""with s as (select o_orderkey as k from orders) select k::varchar as id, case when k % 4 = 0 then 'avoid_road' else 'route' end as task, concat('Market ', k % 11) as start_name, concat('School ', k % 13) as end_name, 2 as n_steps, concat('Row Road ', k % 9) as road, k % 2 = 0 as seen, case when k % 4 = 0 then 'Ring Road' else 'none' end as avoided,
  true as has_nulls from s""")
def scenario_fields(spark, d):
    """Scenarios as JSON text and back: fields that are null are written as such."""
    kept = ["id", "task", "start", "end", "steps", "dest_side", "avoid"]
    rows = order_scenarios(spark, d)
    text = rows.select("id", F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("scenario"))
    path = new_path(spark, "scenarios")
    sinks.parquet(text, path)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    back = spark.read.parquet(path).select("scenario", F.from_json("scenario", kind).alias("s"))
    return back.select(
        "s.id", "s.task", F.col("s.start.name").alias("start_name"), F.col("s.end.name").alias("end_name"), F.size("s.steps").alias("n_steps"), F.get("s.steps", F.lit(0))["road"].alias("road"), F.get("s.steps", F.lit(1))["turn_lms"].isNotNull().alias("seen"),
        F.coalesce("s.avoid.name", F.lit("none")).alias("avoided"), F.contains("scenario", F.lit('"near":null')).alias("has_nulls"),
    )


@query("""with p as (select distinct lower(p_type) as a, lower(p_name) as b from part),
  r as (with recursive d(a, b, i, row) as (select a, b, 0, list_transform(range(0, len(b) + 1), lambda j: 0::bigint) from p
    union all select a, b, i + 1, list_prepend(0::bigint, list_transform(range(1, len(b) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda t: greatest(row[t + 1], case when substr(a, i + 1, 1) = substr(b, t::int, 1) then row[t] + 1 else 0 end))))) from d where i < len(a))
    select a, b, row[len(b) + 1] as lcs from d where i = len(a)) select a, b, round_even(200.0 * lcs / (len(a) + len(b)), 3) as whole from r""" )
def lcs_ratio(spark, d):
    names = table(spark, d, "part").select(F.lower("p_type").alias("a"), F.lower("p_name").alias("b")).distinct()
    return names.select("a", "b", F.bround(fuzzy.ratio(F.col("a"), F.col("b")), 3).alias("whole"))


@query(f"""select a.id as turn, count(b.id) as seen from {L} a left join {L} b on b.id <> a.id and sqrt(((b.lat-a.lat)*111000.0)*((b.lat-a.lat)*111000.0) + ((b.lon-a.lon)*111000.0*cos(radians(a.lat)))*((b.lon-a.lon)*111000.0*cos(radians(a.lat)))) <= 120 group by a.id""")
def sights_in_reach(spark, d):
    """How many other landmarks lie within 120 m of each."""
    rows = fixture(spark, d, "landmarks")
    close = spatial.within(rows.select(F.col("id").alias("turn"), "lat", "lon"), rows.select("id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")), 120.0).where("turn <> id")
    return rows.select(F.col("id").alias("turn")).join(close.groupBy("turn").agg(F.count("*").alias("seen")), "turn", "left").select("turn", F.coalesce("seen", F.lit(0)).alias("seen"))
