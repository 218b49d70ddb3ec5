"""Language identification by multilingual mixture inference.

``fit`` counts hashed byte trigrams of lower-cased text per language over all labelled rows.  ``predict`` cuts a text
into windows of ``window`` bytes, takes each window's trigram log-likelihood under every language, and estimates the
document's language proportions by expectation-maximisation over its windows.  The languages, in order of their
proportions, give nested sets; the set with the highest likelihood less half a log of the windows for each language
is kept.  ``lang_pred`` is its largest language, ``lang_score`` that language's proportion.

The model holds ``2 ** bits`` counts a language; that, times the languages that ``lang`` names, is what reaches the driver and
is broadcast.  Whole texts count, slices of bounded bytes (or one text) at a time.

Defined cases: null text or text without a letter is ``und`` with score 0; rows with null language or text teach
nothing; with no language learned all rows are ``und``; ties go to the language first in alphabetical order; repeated
rows each count; own columns named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from trailhead.llm import common

BITS = 15
RESULTS = ["lang_pred", "lang_score", "lang_set"]


@dataclass
class Model:
    languages: list[str]
    counts: object  # numpy, languages x buckets

    def table(self):
        """Log-probabilities, buckets x languages, with half a count added to each."""
        import numpy as np

        c = self.counts + 0.5
        return np.ascontiguousarray(np.log(c / c.sum(axis=1, keepdims=True)).T.astype(np.float32))


def grams(texts, bits: int = BITS):
    """Trigram bucket at each byte of the lower-cased texts, and where each text begins.  Non-letters of ASCII are one symbol."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    raw = pc.fill_null(pc.utf8_lower(texts.cast(pa.large_string())), "").cast(pa.large_binary())
    if isinstance(raw, pa.ChunkedArray):
        raw = raw.combine_chunks()
    cuts = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[cuts[0] : cuts[-1]] if data is not None and cuts[-1] > cuts[0] else np.zeros(0, np.uint8)
    symbol = np.arange(256, dtype=np.uint32)
    symbol[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]
    s = np.concatenate([symbol[data], np.array([32, 32], np.uint32)])
    h = (s[:-2] * np.uint32(0x9E3779B1)) ^ (s[1:-1] * np.uint32(0x85EBCA77)) ^ (s[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return (h >> np.uint32(32 - bits)).astype(np.int32), cuts - cuts[0]


def fit(docs: DataFrame, bits: int = BITS) -> Model:
    """Learn from text and lang of all rows that have both."""
    import numpy as np

    def count(rows):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in (part for whole in rows for part in common.slices(whole)):
            bucket, cuts = grams(batch.column("text"), bits)
            language = batch.column("lang").to_pylist()
            owner = np.repeat(np.arange(len(language)), np.diff(cuts))
            names = sorted(set(language))
            number = np.array([names.index(x) for x in language])
            both = np.bincount(number[owner] * (1 << bits) + bucket, minlength=len(names) << bits).reshape(len(names), -1)
            for k, name in enumerate(names):
                sums[name] = sums.get(name, 0) + both[k]
        for name, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], names=["lang", "bucket", "n"])

    known = docs.select("text", "lang").where("text is not null and lang is not null")
    found = known.mapInArrow(common.frugal("language", count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique().tolist())
    counts = np.zeros((len(languages), 1 << bits))
    for k, name in enumerate(languages):
        own = found[found["lang"] == name]
        counts[k, own["bucket"].to_numpy()] = own["n"].to_numpy()
    return Model(languages, counts)


def mixtures(likelihood, starts, steps: int = 20):
    """Proportions of the languages in each document, the number kept of them, by EM and penalised likelihood.

    likelihood: windows x languages, log; starts: first window of each document (all have one at least)."""
    import numpy as np

    top = likelihood.max(axis=1, keepdims=True)
    e = np.exp(np.maximum(likelihood - top, -60.0)).astype(np.float64)
    n = np.diff(np.append(starts, len(e)))
    owner = np.repeat(np.arange(len(starts)), n)

    def em(allowed):
        p = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(steps):
            w = p[owner] * e
            w /= np.maximum(w.sum(axis=1, keepdims=True), 1e-300)
            p, old = np.add.reduceat(w, starts, axis=0) / n[:, None], p
            if np.abs(p - old).max() < 1e-4:
                break
        fit = np.add.reduceat(np.log(np.maximum((p[owner] * e).sum(axis=1), 1e-300)), starts)
        return p, fit

    languages = e.shape[1]
    best, _ = em(np.ones((len(starts), languages)))
    order = np.argsort(-best, axis=1, kind="stable")
    chosen = np.zeros_like(best)
    kept, value = np.zeros(len(starts), dtype=int), np.full(len(starts), -np.inf)
    for k in range(1, languages + 1):
        allowed = np.zeros_like(best)
        np.put_along_axis(allowed, order[:, :k], 1.0, axis=1)
        p, fit = em(allowed)
        fit = fit - 0.5 * k * np.log(n + 1)
        better = fit > value + 1e-9
        chosen[better], value[better], kept[better] = p[better], fit[better], k
        if not better.any():
            break
    return chosen, kept


def predict(docs: DataFrame, model: Model, window: int = 48, bits: int = BITS, into: list[str] = RESULTS) -> DataFrame:
    """``docs`` (with text) and, named by ``into``, the largest language, its proportion and the kept languages, largest first."""
    import numpy as np

    docs = docs.drop(*into)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table() if model.languages else None))

    def run(rows):
        import pyarrow as pa
        import pyarrow.compute as pc

        languages, table = shared.value
        for batch in (part for whole in rows for part in common.slices(whole)):
            text = batch.column("text")
            spoken = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False) & bool(languages)
            pred, score, sets = ["und"] * len(text), np.zeros(len(text)), [[] for _ in range(len(text))]
            at = np.flatnonzero(spoken)
            for part in [at] if len(at) else []:
                bucket, cuts = grams(text.take(pa.array(part)), bits)
                n = -(-np.diff(cuts) // window)
                starts = np.concatenate([[0], np.cumsum(n)[:-1]])
                first = np.repeat(cuts[:-1] - starts * window, n) + np.arange(int(n.sum())) * window
                like = np.stack([np.add.reduceat(table[:, k][bucket], first) for k in range(len(languages))], axis=1)
                p, _ = mixtures(like, starts)
                order = np.argsort(-p, axis=1, kind="stable")
                for j, row in enumerate(part.tolist()):
                    pred[row], score[row] = languages[order[j, 0]], min(1.0, p[j, order[j, 0]])
                    sets[row] = [languages[k] for k in order[j] if p[j, k] > 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred), pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string()))], names=[*batch.schema.names, *into])

    new = [StructField(n, t) for n, t in zip(into, (StringType(), DoubleType(), ArrayType(StringType())), strict=True)]
    return docs.mapInArrow(common.frugal("language", run), StructType([*docs.schema.fields, *new]))
