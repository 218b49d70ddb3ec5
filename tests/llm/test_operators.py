"""Operators against brute force, exact round trips and edge cases."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailhead.llm import chat, common, fingerprint, jaccard, langid, neighbours, packing, pieces, quality, queries, token_files, warc

SF = "/root/testdata/sf0.001"
WORD = queries.public_file(queries.WORD_BPE)
EDGE = [(1, "one two three four five six seven"), (2, None), (3, ""), (4, "one two three four five six seven"), (None, "x"), (6, "a b"), (7, "word " * 5000), (1, "one two three four five six seven")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, "en", "s", None, "clash") for i, t in EDGE], "doc_id long, text string, lang string, source string, n_chars long, ids string")


@pytest.fixture(scope="module")
def empty(edge):
    return edge.where("false")


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids + [1]


def test_neighbours_recall_and_order(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = {}
    for r in neighbours.nearest(e, F.col("vec_id") % 50 == 0, leaf_rows=64).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    p = e.toPandas()
    x, ids = np.stack(p.embedding).astype(float), p.vec_id.to_numpy()
    hits = 0
    for q, found in got.items():
        s = x @ x[list(ids).index(q)] / np.linalg.norm(x, axis=1)
        s[list(ids).index(q)] = -np.inf
        hits += len(set(found) & set(ids[np.lexsort((ids, -s))[:5]]))
    assert hits >= 0.9 * 5 * len(got)


def test_neighbours_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [1.0, 0.0]), (7, [0.0, 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"]) for r in neighbours.nearest(v, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 6), (3, 7)]
    assert neighbours.nearest(v.where("false"), F.col("vec_id") == 0).count() == 0
    assert neighbours.nearest(v, F.col("vec_id") == 3).count() == 0


def test_neighbours_repeats_lengths_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 2.0, 4.0]) for i in range(40)] + [(7, [9.0, 1.0, 0.0, 0.0]), (7, [9.0, 1.0, 0.0, 0.0]), (None, [1.0, 2.0, 2.0, 4.0])]
    rows += [(300 + i, [float(i), 1.0]) for i in range(12)] + [(400, [])]
    v = spark.createDataFrame([(i, e, "q", 1.5, 3) for i, e in rows], "vec_id long, embedding array<double>, q string, score double, rank int")
    is_query = F.col("vec_id") % 10 == 0
    got = {}
    for r in neighbours.nearest(v, is_query, leaf_rows=32, confidence=0.999999).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    of = {}
    for i, e in rows:
        if i is not None and e:
            of.setdefault(i, set()).add(tuple(e))
    for q in [i for i in of if i % 10 == 0]:
        x = np.array(min(of[q]))
        want = sorted((-float((np.array(e) * x).sum() / np.sqrt((np.array(e) ** 2).sum()) / np.sqrt((x * x).sum())), i) for i, all_ in of.items() if i != q for e in all_ if len(e) == len(x))[:5]
        assert [i for i, _ in got[q]] == [i for _, i in want], q
        assert np.allclose([s for _, s in got[q]], [-s for s, _ in want], atol=1e-12)


def test_neighbours_recall_among_many(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((40, 32))[rng.integers(0, 40, 8000)] + 0.4 * rng.standard_normal((8000, 32))
    v = spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(v, F.col("vec_id") % 50 == 0, leaf_rows=512).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 8000, 50):
        s = u @ u[q]
        s[q] = -2
        hits += len(got[q] & set(np.argsort(-s)[:5].tolist()))
    assert hits >= 0.95 * 5 * 160


def test_chat_round_trip_and_events(spark):
    nasty = "\\### Assistant: </turn> ok <|end|>\n<|turn|> \\\\"
    turns = spark.createDataFrame([(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 1, "assistant", nasty), (1, 2, None, None), (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    r = {x["conv_id"]: x for x in chat.digest(chat.render(chat.fold(chat.turns_as_events(turns)))).collect()}
    want = "".join(f"{a}\n{b}\n" for a, b in [("user", nasty), ("assistant", nasty), ("assistant", nasty), ("", "")])
    assert r[1]["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r[1]["n_turns"] == 4 and r[None]["n_turns"] == 1
    assert r[1]["loss_sha256"] == hashlib.sha256((nasty * 2).encode()).hexdigest() and r[1]["loss_chars"] == 2 * len(nasty)
    log = [(9, 1, "message", 1, "user", "hi"), (9, 2, "message", 2, "assistant", "a"), (9, 3, "delta", 2, None, "b"), (9, 4, "message", 3, "user", "gone"), (9, 5, "regenerate", 2, None, ""), (9, 6, "delta", 2, None, "c"), (9, 7, "edit", 1, None, "hello"), (9, 8, "delta", 2, None, "d")]
    got = chat.fold(spark.createDataFrame(log, "conv_id long, seq long, kind string, message_id long, role string, text string")).orderBy("created").collect()
    assert [(x["role"], x["text"]) for x in got] == [("user", "hello"), ("assistant", "cd")]
    assert chat.digest(chat.render(chat.fold(chat.turns_as_events(turns.where("false"))))).count() == 0


def test_token_files(spark, edge, empty):
    path = common.new_path(spark, "t")
    token_files.write_tokens(edge, path, WORD)
    got = token_files.digest(token_files.with_starts(spark, path)).orderBy("start").collect()
    start = 0
    for r, (i, t) in zip(got, sorted(EDGE, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        ids = library_ids(t)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    path = common.new_path(spark, "t")
    token_files.write_tokens(empty, path, WORD, encoding="delta")
    assert token_files.with_starts(spark, path).count() == 0


def test_packing_covers_each_token_once(spark, edge, empty):
    got = packing.pack(edge.repartition(2), WORD, capacity=64).collect()
    where, docs = {}, {}
    for r in got:
        where.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for parts in where.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or at & (at - 1) == 0
    assert sum(n for _, n in docs[7]) == len(library_ids("word " * 5000))
    assert sum(r["length"] for r in got) == sum(len(library_ids(t)) for _, t in EDGE)
    assert packing.pack(empty, WORD).count() == 0


def test_pieces_are_best(spark, edge, empty):
    p = pieces.loaded(queries.public_file(queries.PIECE_MODEL))
    scores = {w: v for w, v in p.words.items()}

    def best(text):
        text, b = pieces.MARK + text.replace(" ", pieces.MARK), [0.0]
        for j in range(1, len(text) + 1):
            known = [b[j - n] + scores[text[j - n : j]][1] for n in range(1, min(j, 20) + 1) if text[j - n : j] in scores]
            b.append(max(known + ([] if text[j - 1] in scores else [b[j - 1] + p.unknown_score])))
        return b[-1]

    score_of = {i: s for _, s, i in scores.values()}
    for text in ["the anat of lere", "Ñandú für  zwei", "a b", "x"]:
        ids = np.frombuffer(p.encode(text), "<u4").astype(int)
        if all(i in score_of for i in ids):
            assert sum(score_of[i] for i in ids) == best(text)
        assert p.decode(ids).decode() == text
    for text in ["a\n\nb ", " \n x", "日本 🎉\t", "  lead"]:
        assert p.decode(np.frombuffer(p.encode(text), "<u4").astype(int)).decode() == text
    assert [r["same"] for r in pieces.round_trip(edge, queries.public_file(queries.PIECE_MODEL)).collect()] == [True] * len(EDGE)
    assert pieces.round_trip(empty, queries.public_file(queries.PIECE_MODEL)).count() == 0


def test_fingerprints(spark, edge, empty):
    got = fingerprint.edited(edge).collect()
    assert len(got) == len(EDGE) and len({r["fingerprint"] for r in got if r["doc_id"] in (1, 4)}) == 1
    order = sorted(EDGE, key=lambda x: (x[0] is None, -(x[0] or 0), [-ord(c) for c in x[1] or ""]))
    texts = [t or "" for _, t in order]
    want = sorted(hashlib.sha256((x[: len(x) - len(x) // 3] + y[: len(x) // 3]).encode()).hexdigest() for x, y in zip(texts, texts[1:] + texts[:1], strict=True))
    assert sorted(r["edited_sha256"] for r in got) == want
    assert fingerprint.edited(empty).count() == 0


def test_fingerprints_estimate_jaccard(spark):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    miss = []
    for r in fingerprint.edited(docs).collect():
        t, n = texts[r["doc_id"]], len(texts[r["doc_id"]]) // 3
        a, b = shingles(t), shingles(t[: len(t) - n] + texts[after[r["doc_id"]]][:n])
        miss.append(r["near_edited"] - len(a & b) / max(1, len(a | b)))
    assert abs(np.mean(miss)) < 0.01 and np.std(miss) < 0.06


def test_quality(spark, edge, empty):
    rows = queries.op8_quality(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    model = quality.fit(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r["quality_score"] for r in quality.score(edge, model).collect()] == [0.5] * len(EDGE)


def test_language(spark, edge, empty):
    rows = queries.op10_language(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    got = langid.predict(edge, langid.fit(edge)).collect()
    assert [r["lang_pred"] for r in got] == ["en" if t else "und" for _, t in EDGE]
    assert {r["lang_pred"] for r in langid.predict(edge, langid.fit(empty)).collect()} == {"und"}


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 80)])
def test_jaccard_is_exact(spark, width, percent):
    rng = np.random.default_rng(width)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 300, n)) for n in (3, 12, 30, 90, 200)]
    rows = [(k, t) for k, t in enumerate(base)]
    for t in base:
        for _ in range(25):
            w = t.split()
            for _ in range(rng.integers(0, 4)):
                w[rng.integers(0, len(w))] = f"n{rng.integers(0, 50)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, "a"), (1003, "A"), (1002, "a")]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = sorted((rows[k][0], len(sets[k]), rows[root(k)][0]) for k in range(len(rows)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.components(docs, width, percent).collect()) == want
    assert jaccard.components(docs.where("false"), width, percent).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        docs, _ = common.written(kept, "s")
    assert 0 < docs.count() < 200
    assert p.STAGES[-1][1](spark, docs, SF).count() > 0
