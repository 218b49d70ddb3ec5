"""Quality by compression: two zstandard dictionaries, trained on good and on bad labelled text.

A text is cut into blocks of ``block`` bytes, each is compressed with either dictionary, and the difference of the
compressed sizes over their sum is the text's margin.  Short blocks keep the dictionaries decisive however long the
text is.  Logistic regression on labelled texts that the dictionaries were not made from turns margin (and the plain
compression ratio) into a score from 0 to 1, with the margin's spread for a text of that length taken into account.

Bounds of the fit: at most ``dictionary_blocks`` blocks, from labelled rows of ``dictionary_docs`` ids, for each dictionary, and
the features of ``calibration_docs`` labelled rows of each class for the calibration, all taken in the order of a hash; no
more comes to the driver, however often an id is repeated.  Scoring covers whole texts of all rows, a batch at a time.

Defined cases: null and empty texts have margin 0 and score ``model.empty``; a repeated doc_id is scored for each row; an id
with both labels counts as good; a missing class gives the share of good labels as every score; too few blocks to train a
dictionary make it the blocks themselves; an empty table gives no rows; further columns stay, whatever their names, but an
own ``quality_score`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailhead.llm import common


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]  # for the features of ``features``
    block: int
    empty: float


def features(texts: list[bytes], good: bytes, bad: bytes, block: int, level: int = 3):
    """Rows (1, margin, margin * log length, ratio) of texts, from compressed sizes under both dictionaries."""
    import numpy as np
    import zstandard as z

    pair = []
    for d in (good, bad):
        dictionary = z.ZstdCompressionDict(d)
        dictionary.precompute_compress(level=level)
        pair.append(z.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_dict_id=False))
    out = np.zeros((len(texts), 4))
    for k, t in enumerate(texts):
        g = b = 0
        for at in range(0, len(t), block):
            part = t[at : at + block]
            g += len(pair[0].compress(part))
            b += len(pair[1].compress(part))
        margin = (b - g) / (b + g) if g else 0.0
        out[k] = 1.0, margin, margin * np.log1p(min(len(t), 8 * block) / 64), g / len(t) if t else 0.5
    return out


def dictionary(blocks: list[bytes], size: int = 1 << 18) -> bytes:
    """A trained dictionary of ``size`` bytes at most; the blocks themselves where they are too few to train one."""
    import zstandard as z

    try:
        return z.train_dictionary(size, blocks).as_bytes()
    except z.ZstdError:
        return b"\n".join(blocks)[-size:]


def logistic(x, y, steps: int = 50, ridge: float = 1e-3):
    """Newton's method for ridge-penalised logistic regression."""
    import numpy as np

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * len(x) * np.eye(len(w)) * 0.01 + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * len(x) * 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, block: int = 1024, dictionary_docs: int = 1500, dictionary_blocks: int = 1500, calibration_docs: int = 3000) -> Model:
    """Learn from rows of ``docs`` (doc_id, text) with a quality in ``labels``.

    Ids are drawn first, from ids and labels alone; at most ``2 * (dictionary_docs + calibration_docs)`` of them are
    broadcast to fetch their texts, so no text is shuffled."""
    import numpy as np

    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    ids = known.join(docs.where("length(text) > 0").select("doc_id"), "doc_id", "left_semi")
    counts = {r["quality"]: r["n"] for r in ids.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if not counts.get(0) or not counts.get(1):
        return Model(b" ", b" ", [0.0] * 4, block, share if counts else 0.5)
    order = F.xxhash64(F.col("doc_id"), F.lit("fit"))
    drawn = [ids.where((F.col("quality") == q) & (F.pmod(order, F.lit(2)) == part)).select("doc_id", "quality", order.alias("o")).orderBy("o", "doc_id").limit(n) for q in (0, 1) for part, n in ((0, dictionary_docs), (1, calibration_docs))]
    drawn, _ = common.written(drawn[0].unionByName(drawn[1]).unionByName(drawn[2]).unionByName(drawn[3]), "drawn")
    rows = docs.select("doc_id", "text").where("length(text) > 0").join(F.broadcast(drawn), "doc_id").withColumn("part", F.pmod("o", F.lit(2)))
    cut = F.expr(f"explode(transform(sequence(0, cast((length(text) - 1) div {block} as int)), i -> substring(text, i * {block} + 1, {block})))")
    blocks = rows.where("part = 0").select("quality", "o", cut.alias("b")).select("quality", F.xxhash64("o", "b").alias("o"), "b")
    texts = {q: [r.b.encode() for r in blocks.where(F.col("quality") == q).orderBy("o", "b").limit(dictionary_blocks).select("b").collect()] for q in (0, 1)}
    good, bad = dictionary(texts[1]), dictionary(texts[0])
    # Whole texts are measured where they lie; only features, of a bounded number of rows, come to the driver.
    found = rows.where("part = 1").select("quality", "o", "text").mapInArrow(common.frugal("quality", _measure(good, bad, block)), "quality int, o long, f array<double>")
    nth = F.row_number().over(Window.partitionBy("quality").orderBy("o", "f"))
    found = found.withColumn("nth", nth).where(F.col("nth") <= calibration_docs).select("quality", "f").collect()
    if not good or not bad or len({r.quality for r in found}) < 2:
        return Model(b" ", b" ", [0.0] * 4, block, share)
    x, y = np.array([r.f for r in found]), np.array([float(r.quality) for r in found])
    weights = logistic(x, y)
    # The sample holds both classes alike; move the intercept to the classes' shares among all labelled rows.
    shown = y.mean()
    weights[0] += np.log(share / (1 - share)) - np.log(shown / (1 - shown))
    empty = 1 / (1 + np.exp(-(weights[0] + weights[3] * 0.5)))
    return Model(good, bad, weights.tolist(), block, float(empty))


def _measure(good: bytes, bad: bytes, block: int):
    def run(rows):
        import pyarrow as pa

        for batch in (part for whole in rows for part in common.slices(whole)):
            x = features(batch.column("text").cast(pa.binary()).to_pylist(), good, bad, block)
            yield pa.RecordBatch.from_arrays([batch.column("quality").cast(pa.int32()), batch.column("o"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["quality", "o", "f"])

    return run


def score(docs: DataFrame, model: Model, into: str = "quality_score") -> DataFrame:
    """``docs`` (doc_id, text) with a column ``into``; further columns stay.  An own column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(into)

    def run(rows):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        for batch in (part for whole in rows for part in common.slices(whole)):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            if any(m.weights):
                s = 1 / (1 + np.exp(-np.clip(features(texts, m.good, m.bad, m.block) @ np.array(m.weights), -30, 30)))
                s[[k for k, t in enumerate(texts) if not t]] = m.empty
            else:
                s = np.full(len(texts), m.empty)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, into])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(common.frugal("quality", run), StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def train_rows(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Rows outside the held-out fold."""
    return docs.where(common.fold_bucket(F.col("doc_id"), folds) != 0)
