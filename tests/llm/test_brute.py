"""Operators against plain Python forms of themselves, and the pipeline's stages on awkward rows."""

import glob
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trailhead.llm import chat, common, jaccard, langid, packing, pieces, quality, queries, token_files, tokens

SF = "/root/testdata/sf0.001"
WORD, PIECES = queries.public_file(queries.WORD_BPE), queries.public_file(queries.PIECE_MODEL)
LONG = " ".join(f"word{i % 700}" for i in range(60_000))


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with nulls, empty and very long texts, repeated ids with other texts, repeated rows and clashing columns."""
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    near = " ".join(rows[0][1].split()[:-1]) if rows[0][1] and len(rows[0][1].split()) > 40 else rows[1][1]
    rows += [(None, None, None, None, None), (None, rows[3][1], "en", "s", 1), (None, "only a null id says this here", "en", "s", 1), (9001, "", "en", "s", 0), (9002, " \t\n ", None, "s", 3), (9003, LONG, "en", None, len(LONG)), (9003, LONG, "en", None, len(LONG))]
    rows += [(9004, rows[5][1], "de", "s", 1), (9004, rows[8][1], "en", "s", 1), (9004, "entirely other words stand in this second text", "en", "s", 1), (9005, near, "en", "s", 1), (9006, "x", "en", "s", 1), (9007, "12345 67 !!", "en", "s", 1)]
    clash = [(*r, "h", 1, 2, "words", 0.5, "und", 7) for r in rows]
    return spark.createDataFrame(clash, "doc_id long, text string, lang string, source string, n_chars long, h string, id0 int, copies int, words string, quality_score double, lang_pred string, class int")


# ---- tokens ----


def test_encoder_is_the_library(spark):
    from tokenizers import Tokenizer

    t, mine = Tokenizer.from_file(WORD), tokens.WordEncoder(WORD, None, memo_words=2000)
    rng = random.Random(7)
    alphabet = [*"abzAZ019.,;:!?'\"-_/()<|>  \t\n", "\u0085", " ", "İ", "ı", "ß", "é", "é", "́", "̇", "ͅ", "ñ", "ª", "²", "½", "Σ", "ς", "日", "ا", "😀", "'s", "'LL", "<|endoftext|>", "<|", "ﬁ", "K", "̸", "\x00", "\x1c"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16))) for _ in range(50_000)]
    texts += [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()] + ["İ, İ", LONG]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        got = mine.encode([x.encode() for x in part])
        for text, ids, want in zip(part, got, t.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, text[:60]


@pytest.mark.parametrize("encoding, mark", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_token_files_are_laid_out_for_selective_reads(spark, encoding, mark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = common.new_path(spark, "tok")
    token_files.write_tokens(docs, path, WORD, encoding=encoding, row_group_mb=1, shards=2)
    files, groups = glob.glob(path.removeprefix("file://") + "/*.parquet"), 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
            ids = next(c for c in columns if c.path_in_schema.startswith("ids"))
            assert mark in ids.encodings and all(c.has_offset_index and c.has_column_index for c in columns)
            groups += 1
    assert len(files) == 2 and groups >= 2
    only = token_files.read_tokens(spark, path, ["doc_id", "n_tokens"]).where("doc_id = 77")
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in re.search(r"ReadSchema: (\S+)", plan)[1] and "EqualTo(doc_id,77)" in plan and only.count() == 1
    got = token_files.digest(token_files.with_starts(spark, path)).orderBy("doc_id").collect()
    e, start = tokens.WordEncoder(WORD, 1), 0
    for r, (i, text) in zip(got, sorted(docs.select("doc_id", "text").collect()), strict=True):
        ids = e.encode([(text or "").encode()])[0]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def test_one_repeated_id_is_split_among_shards(spark):
    rows = spark.range(4000).selectExpr("case when id % 3 > 0 then 5 else id end as doc_id", "concat('text ', id) as text").repartition(4)
    path = common.new_path(spark, "tok")
    token_files.write_tokens(rows, path, WORD, shards=8)
    found = token_files.with_starts(spark, path)
    sizes = [r["n"] for r in found.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500
    in_order = found.orderBy("start").select("doc_id", "start", "n_tokens").collect()
    assert [r["doc_id"] for r in in_order] == sorted(r["doc_id"] for r in in_order) and all(a["start"] + a["n_tokens"] == b["start"] for a, b in itertools.pairwise(in_order))


# ---- packing ----


def plain_plan(lengths, capacity, longest, linear, quadratic):
    """The packing rule with lists: equal parts, longest first to the cheapest sequence with room, the others cut."""
    parts = []
    for k, n in enumerate(lengths):
        m = math.ceil(n / longest)
        at = [n * j // m for j in range(m + 1)]
        parts += [(b - a, k, a) for a, b in itertools.pairwise(at)]
    total = sum(lengths)
    sizes = [capacity] * (total // capacity) + [2**b for b in range(20, -1, -1) if total % capacity & 2**b]
    room, cost, out, over = list(sizes), [0.0] * len(sizes), [], []

    def put(n, k, a, s):
        out.append((k, a, n, s, sizes[s] - room[s]))
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    for n, k, a in sorted(parts, key=lambda r: (-r[0], r[1], r[2])):
        open_ = [s for s in range(len(sizes)) if room[s] >= n]
        if open_:
            put(n, k, a, min(open_, key=lambda s: (cost[s], s)))
        else:
            over.append((n, k, a))
    for n, k, a in over:
        while n:
            s = min((s for s in range(len(sizes)) if room[s]), key=lambda s: (cost[s], s))
            take = min(n, room[s])
            put(take, k, a, s)
            n, a = n - take, a + take
    return out


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_the_plain_rule(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 5, 30, 63, 64, 65, 200, rng.randint(1, 500)]) for _ in range(60)]
    assert sorted(packing.plan(lengths, 64, 32, 1.0, 0.02)) == sorted(plain_plan(lengths, 64, 32, 1.0, 0.02))


def test_pieces_hold_the_librarys_ids_and_balance(spark, docs):
    e = tokens.WordEncoder(WORD, 1)
    of = {}
    for r in docs.select("doc_id", "text").collect():
        of.setdefault(r["doc_id"], []).append(e.encode([(r["text"] or "").encode()])[0])
    rows = packing.pack(docs.repartition(3), WORD).collect()
    sequences, covered = {}, 0
    for r in rows:
        assert any(len(x) // 4 == r["doc_tokens"] and zlib.crc32(x[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"] for x in of[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append(r)
        covered += r["length"]
    assert covered == sum(len(x) // 4 for v in of.values() for x in v)
    for parts in sequences.values():
        n = sum(r["length"] for r in parts)
        assert all(r["sequence_length"] == n and math.isclose(r["sequence_cost"], sum(p["length"] + p["length"] ** 2 / 1024 for p in parts)) for r in parts)
        assert n == 2048 or n & (n - 1) == 0
    full = [p[0]["sequence_cost"] for p in sequences.values() if p[0]["sequence_length"] == 2048]
    assert len(full) > 20 and max(full) < 4200


# ---- quality ----


def test_quality_scores_are_the_plain_rule(spark, docs):
    import zstandard as z

    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.fit(quality.train_rows(base, 5), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))

    def size(d, part):
        return len(z.ZstdCompressor(level=3, dict_data=z.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(part))

    got = quality.score(docs, model)
    assert got.columns == [c for c in docs.columns if c != "quality_score"] + ["quality_score"]
    for r in got.orderBy(F.length("text")).limit(60).union(got.where(F.length("text") > 100_000)).collect():
        t = (r["text"] or "").encode()
        if not t:
            assert math.isclose(r["quality_score"], model.empty)
            continue
        parts = [t[i : i + model.block] for i in range(0, len(t), model.block)]
        g, b = sum(size(model.good, p) for p in parts), sum(size(model.bad, p) for p in parts)
        margin = (b - g) / (b + g)
        x = [1.0, margin, margin * math.log1p(min(len(t), 8 * model.block) / 64), g / len(t)]
        assert math.isclose(r["quality_score"], 1 / (1 + math.exp(-sum(p * q for p, q in zip(x, model.weights, strict=True)))), rel_tol=1e-9)


def test_quality_draws_a_bounded_number_of_rows(spark):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    labelled = base.join(labels.where("quality = 1").select("doc_id"), "doc_id").where("length(text) > 0").limit(1).select("doc_id").first()[0]
    many = base.unionByName(spark.range(5000).select(F.lit(labelled).alias("doc_id"), F.concat(F.lit("repeated text "), "id").alias("text")))
    seen = []
    plain, quality.logistic = quality.logistic, lambda x, y: seen.append(len(y)) or plain(x, y)
    try:
        quality.fit(many, labels, calibration_docs=50)
    finally:
        quality.logistic = plain
    assert seen and seen[0] <= 100
    both = labels.select("doc_id", F.lit(0).alias("quality")).unionByName(labels.select("doc_id", F.lit(1).alias("quality")))
    assert {round(r["quality_score"], 6) for r in quality.score(base.limit(5), quality.fit(base, both)).collect()} == {1.0}  # conflicting labels: good


# ---- languages ----


def plain_mixture(like, steps=20):
    """Proportions by EM over one document's windows, and the penalised choice of languages, with loops."""
    n, languages = len(like), len(like[0])
    e = [[math.exp(max(x - max(w), -60.0)) for x in w] for w in like]

    def em(allowed):
        p = [a / sum(allowed) for a in allowed]
        for _ in range(steps):
            share = [0.0] * languages
            for w in e:
                total = max(sum(a * b for a, b in zip(p, w, strict=True)), 1e-300)
                for k in range(languages):
                    share[k] += p[k] * w[k] / total / n
            done = max(abs(a - b) for a, b in zip(p, share, strict=True)) < 1e-4
            p = share
            if done:
                break
        return p, sum(math.log(max(sum(a * b for a, b in zip(p, w, strict=True)), 1e-300)) for w in e)

    first, _ = em([1.0] * languages)
    order = sorted(range(languages), key=lambda k: -first[k])
    best, value = None, -math.inf
    for k in range(1, languages + 1):
        p, fit = em([1.0 if x in order[:k] else 0.0 for x in range(languages)])
        fit -= 0.5 * k * math.log(n + 1)
        if fit > value + 1e-9:
            best, value = p, fit
        else:
            break
    return best


def test_mixtures_are_the_plain_rule():
    rng = np.random.default_rng(3)
    sizes = [1, 2, 5, 30]
    like = -rng.gamma(3.0, 8.0, (sum(sizes), 4)).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for d, n in enumerate(sizes):  # one document at a time: documents of one batch share their last step
        part = like[starts[d] : starts[d] + n]
        got, kept = langid.mixtures(part, np.array([0]))
        want = plain_mixture(part.tolist())
        assert np.allclose(got[0], want, atol=1e-5) and kept[0] == sum(x > 0 for x in want)


def test_language_sets_and_replaced_columns(spark, docs):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(base)
    texts = {r["lang"]: r["t"] for r in base.where("length(text) > 2000").groupBy("lang").agg(F.max("text").alias("t")).collect() if r["lang"]}
    a, b = sorted(texts)[:2]
    mixed = spark.createDataFrame([(1, texts[a][:2000] + " " + texts[b][:2000], "x"), (2, texts[a], "y")], "doc_id long, text string, lang_set string")
    got = {r["doc_id"]: r for r in langid.predict(mixed, model).collect()}
    assert set(got[1]["lang_set"]) == {a, b} and got[1]["lang_pred"] in (a, b) and got[1]["lang_score"] < 0.9 and got[2]["lang_pred"] == a
    rows = langid.predict(docs, model)
    assert rows.columns == [c for c in docs.columns if c != "lang_pred"] + langid.RESULTS
    assert {r["lang_pred"] for r in rows.where("text is null or text = '' or doc_id in (9002, 9007)").collect()} == {"und"}


# ---- chat ----


def plain_fold(events):
    """One conversation's log (seq, kind, message_id, role, text), event after event."""
    found = {}
    for seq, kind, mid, role, text in sorted(events, key=lambda e: e[0]):
        m = found.setdefault(mid, {"opened": None, "first": seq, "role": None, "text": "", "again": None})
        if kind == "message" and m["opened"] is None:
            m["opened"] = seq
        m["text"] = m["text"] + (text or "") if kind == "delta" else text or ""
        m["role"] = role if m["role"] is None else m["role"]
        m["again"] = seq if kind == "regenerate" else m["again"]
    order = sorted((m["opened"] if m["opened"] is not None else m["first"], mid) for mid, m in found.items())
    out = []
    for at, (created, mid) in enumerate(order):
        if all(found[x]["again"] is None or found[x]["again"] <= created for _, x in order[:at]):
            out.append((found[mid]["role"] or "", found[mid]["text"]))
    return out


def test_random_logs_fold_like_the_plain_rule(spark):
    rng = random.Random(11)
    logs, rows = {}, []
    for conv in range(60):
        seqs = rng.sample(range(100), rng.randint(1, 25))
        logs[conv] = [(s, rng.choice(["message", "delta", "delta", "edit", "regenerate"]), rng.randint(0, 5), rng.choice([None, "user", "assistant"]), rng.choice([None, "", "a", "<|end|>", "\\"])) for s in seqs]
        rows += [(conv, *e, "clash", 3) for e in logs[conv]]
    rng.shuffle(rows)
    events = spark.createDataFrame(rows, "conv_id long, seq long, kind string, message_id long, role string, text string, created string, steps int")
    got = {}
    for r in chat.fold(events).orderBy("conv_id", "created", "message_id").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {c: plain_fold(e) for c, e in logs.items()}
    long = spark.createDataFrame([(1, 1, "message", 1, "assistant", LONG)] + [(1, 2 + i, "delta", 1, None, "x") for i in range(3000)], "conv_id long, seq long, kind string, message_id long, role string, text string")
    assert chat.digest(chat.render(chat.fold(long))).first()["loss_chars"] == len(LONG) + 3000


def test_pieces_both_ways_in_one_worker_and_in_two(spark, docs):
    rows = docs.select("doc_id", "text", F.lit("x").alias("ids"), F.lit(1).alias("decoded"))
    one = pieces.encode_and_decode(rows, PIECES)
    two = pieces.decode(pieces.encode(rows, PIECES), PIECES)
    plain = lambda d: sorted((str(r["doc_id"]), r["text"] or "", tuple(r["ids"]), r["decoded"]) for r in d.select("doc_id", "text", "ids", "decoded").collect())
    assert plain(one) == plain(two)
    assert all((r["text"] or "") == r["decoded"] for r in one.collect())


# ---- the pipeline ----


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def groups_of(rows, width, percent):
    """The number of each row's group of linked texts; rows without words have None."""
    sets = []
    for r in rows:
        w = words_of(r["text"])
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * min(len(sets[i]), len(sets[j])) >= percent * max(len(sets[i]), len(sets[j])):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(j)] = root(i)
    return [root(i) if sets[i] else None for i in range(len(rows))]


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark, docs):
    import corpus_pipeline as p

    rows = docs.collect()
    groups = groups_of(rows, p.NEAR_WIDTH, p.NEAR_PERCENT)
    kept = p.near_duplicate_stage(spark, docs, SF)
    assert kept.schema == docs.schema
    got = kept.collect()
    assert len(got) == len({g for g in groups if g is not None}) + groups.count(None)
    place = {}
    for r, g in zip(rows, groups, strict=True):
        place.setdefault(tuple(r), set()).add(g)
    seen = [g for r in got for g in place[tuple(r)] if g is not None]
    assert sorted(seen) == sorted({g for g in groups if g is not None})
    for r in got:  # the least id of its group, a null id only where there is no other
        group = {rows[i]["doc_id"] for i, g in enumerate(groups) if g is not None and g in place[tuple(r)]}
        ids = [i for i in group if i is not None]
        assert not group or r["doc_id"] == (min(ids) if ids else None)
    assert sum(r["doc_id"] == 9004 for r in got) >= 1 and "entirely other words stand in this second text" in {r["text"] for r in got}
    assert p.near_duplicate_stage(spark, docs.where("false"), SF).count() == 0


def test_components_link_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text), (None, text + " z"), (None, "alone is this row of words"), (8, text + " z")]
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("7", "7"), ("8", "7"), ("None", "7"), ("None", "None")]


def test_filtering_stages_keep_what_the_models_say(spark, docs):
    import corpus_pipeline as p

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(quality.train_rows(docs, 5), labels)
    plain = lambda d: sorted(map(str, d.select(docs.columns).collect()))
    want = quality.score(docs, model, "s").where(f"s >= {p.KEEP_QUALITY}")
    kept = p.quality_stage(spark, docs, SF)
    assert kept.schema == docs.schema and plain(kept) == plain(want)
    spoken = langid.predict(docs, langid.fit(docs.where(common.fold_bucket(F.col("doc_id"), 4) != 2)), into=["l", "s", "all"])
    kept = p.language_stage(spark, docs, SF)
    assert kept.schema == docs.schema and plain(kept) == plain(spoken.where(f"l <> 'und' and s >= {p.KEEP_LANGUAGE}"))
    for stage in (p.quality_stage, p.language_stage, p.packing_stage):
        assert stage(spark, docs.where("false"), SF).count() == 0
    assert p.packing_stage(spark, docs, SF).agg(F.sum("length")).first()[0] == sum(len(x) // 4 for x in tokens.WordEncoder(WORD, 1).encode([(r["text"] or "").encode() for r in docs.collect()]))
    assert [n for n, _ in p.STAGES] == ["quality", "language", "near_duplicates", "packing"]
