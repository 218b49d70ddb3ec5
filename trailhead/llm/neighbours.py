"""Approximate nearest neighbours by low-dimensional stable projections under a kd-tree.

Vectors are scaled to length 1 (so the nearest are those of largest cosine) and projected to ``dims`` Gaussian
coordinates.  If two vectors lie ``d`` apart, their squared projected distance is ``d * d`` times a chi-square variable
of ``dims`` degrees.  A search takes candidates in the order of the kd-tree's projected distances, verifies each on the
original vectors in double precision, and stops once the next projected distance is so large that a vector as near as
the ``k``-th found would lie there with probability under ``1 - confidence``.

The kd-tree has two levels.  Its upper splits come from a bounded sample of projections and cut the data into leaves of
about ``leaf_rows`` vectors (more, once there are ``MOST_LEAVES``), one group each; in a leaf the tree goes on down to buckets.  A query is first answered in its own
leaf; the distance found there bounds the stopping radius, so its second round visits just the leaves whose boxes lie
within that radius.  Every vector is indexed; nothing caps candidates.  Only leaf boxes (a few numbers a leaf) and the
sample (``dims`` numbers a row) reach the driver.

Copies: of equal vectors the ``k + 1`` smallest ids stand for all, which is enough for any answer; the limit is applied
before the shuffle, so a vector that a third of the rows share stays cheap.  Queries of equal vectors are searched once.

Defined cases: vectors that are null, zero, empty, or hold null or non-finite components take no part; vectors of different
lengths have no cosine, so each length is searched by itself; a null id takes no part; fewer than ``k`` candidates give
fewer rows; ties go to the smaller id; a repeated id counts once per distinct vector as a candidate, and its least vector is
its query; empty tables give no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailhead.llm import common

SAMPLE, MOST_LEAVES = 16384, 1 << 16


def chi_square_quantile(p: float, dims: int) -> float:
    """The value that a chi-square variable of ``dims`` (even) degrees exceeds with probability 1 - p."""

    def above(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if above(mid) > 1 - p else (low, mid)
    return high


def projection(width: int, dims: int, seed: int):
    import numpy as np

    return np.random.default_rng(seed).standard_normal((width, dims))


def matrix(column, width: int):
    """Rows of an Arrow list column as a numpy matrix of doubles."""
    import numpy as np

    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, width)


def unit(x):
    import numpy as np

    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def splits(points, leaves: int):
    """A balanced kd-tree of about ``leaves`` leaves: nodes (axis, cut, left, right); a negative child -1-n is leaf n."""
    import numpy as np

    nodes, count = [], 0

    def grow(idx, want):
        nonlocal count
        spread = np.ptp(points[idx], axis=0) if len(idx) > 1 else np.zeros(1)
        if want <= 1 or spread.max() <= 0:
            count += 1
            return -count
        axis = int(spread.argmax())
        v = points[idx, axis]
        cut = float(np.quantile(v, (want // 2) / want))
        if not (v < cut).any():
            cut = float(v[v > v.min()].min())
        at = len(nodes)
        nodes.append(None)
        left = grow(idx[v < cut], want // 2)
        right = grow(idx[v >= cut], want - want // 2)
        nodes[at] = (axis, cut, left, right)
        return at

    return (grow(np.arange(len(points)), leaves) if len(points) else -1), nodes, max(count, 1)


def leaf_of(points, root: int, nodes):
    import numpy as np

    out = np.zeros(len(points), dtype=np.int64)

    def walk(node, idx):
        if node < 0:
            out[idx] = -1 - node
            return
        axis, cut, left, right = nodes[node]
        below = points[idx, axis] < cut
        walk(left, idx[below])
        walk(right, idx[~below])

    walk(root, np.arange(len(points)))
    return out


class Tree:
    """kd-tree over projected points with buckets of at most ``bucket`` points (more only if they coincide)."""

    def __init__(self, points, bucket: int = 256):
        import numpy as np

        self.points, self.nodes = points, []  # (low, high, left, right, rows)

        def grow(idx):
            p = points[idx]
            low, high = p.min(axis=0), p.max(axis=0)
            at = len(self.nodes)
            self.nodes.append(None)
            axis = int((high - low).argmax())
            if len(idx) <= bucket or high[axis] <= low[axis]:
                self.nodes[at] = (low, high, -1, -1, idx)
                return at
            order = idx[np.argsort(p[:, axis], kind="stable")]
            half = len(order) // 2
            self.nodes[at] = (low, high, grow(order[:half]), grow(order[half:]), None)
            return at

        grow(np.arange(len(points)))

    def search(self, q, verify, radius):
        """Buckets nearest first: ``verify(rows)`` gets rows within ``radius()``, which it may shrink; ends beyond it."""
        import heapq

        import numpy as np

        def gap(node):
            low, high = self.nodes[node][:2]
            d = np.maximum(0.0, np.maximum(low - q, q - high))
            return float(d @ d)

        heap = [(gap(0), 0)]
        while heap:
            d, node = heapq.heappop(heap)
            if d > radius():
                return
            _, _, left, right, rows = self.nodes[node]
            if rows is None:
                heapq.heappush(heap, (gap(left), left))
                heapq.heappush(heap, (gap(right), right))
            else:
                delta = self.points[rows] - q
                near = (delta * delta).sum(axis=1)
                verify(rows[near <= radius()])


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that take part, of any length."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 8, confidence: float = 0.99, leaf_rows: int = 8192, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest other rows.  ``is_query``: a condition on ``vec_id``."""
    spark = vectors.sparkSession
    rows = valid(vectors, id_col, vec_col)
    widths = sorted(r["n"] for r in rows.select(F.size("embedding").alias("n")).distinct().collect())
    queries = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for width in widths:
        of_width = F.size("embedding") == width
        found = of_one_width(rows.where(of_width), queries.where(of_width), width, k, dims, confidence, leaf_rows, seed)
        out = found if len(widths) == 1 else out.unionByName(found)
    return out


def of_one_width(rows: DataFrame, queries: DataFrame, width: int, k: int, dims: int, confidence: float, leaf_rows: int, seed: int) -> DataFrame:
    """``nearest`` of queries (query_id, embedding) among rows (vec_id, embedding), all vectors being valid and ``width`` long."""
    import numpy as np

    spark = rows.sparkSession
    first = Window.partitionBy("embedding").orderBy("vec_id")
    copies = rows.withColumn("nth", F.dense_rank().over(first)).where(F.col("nth") <= k + 1)
    distinct, _ = common.written(copies.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "vectors")
    g = projection(width, dims, seed)
    leaves = min(MOST_LEAVES, -(-distinct.count() // leaf_rows))

    def project(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array((unit(matrix(b.column("embedding"), width)) @ g).tolist(), pa.list_(pa.float64()))], names=["p"])

    sample = distinct.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(max(SAMPLE, 4 * leaves)).mapInArrow(project, "p array<double>").toArrow()
    root, nodes, _ = splits(matrix(sample["p"], dims), max(1, leaves))
    tree = spark.sparkContext.broadcast((g, root, nodes))

    def place(batches):
        import pyarrow as pa

        g, root, nodes = tree.value
        for b in batches:
            p = unit(matrix(b.column("embedding"), width)) @ g
            yield pa.RecordBatch.from_arrays([pa.array(leaf_of(p, root, nodes)), *b.columns, pa.array(p.tolist(), pa.list_(pa.float64()))], names=["leaf", *b.schema.names, "p"])

    placed = distinct.mapInArrow(place, "leaf long, embedding array<double>, ids array<long>, p array<double>")
    box = placed.groupBy("leaf").agg(*[f(F.col("p")[j]).alias(f"{n}{j}") for n, f in (("lo", F.min), ("hi", F.max)) for j in range(dims)]).collect()
    bounds_of = lambda n: np.array([[r[f"{n}{j}"] for j in range(dims)] for r in box]).reshape(-1, dims)
    boxes = spark.sparkContext.broadcast((np.array([r["leaf"] for r in box], dtype=np.int64), bounds_of("lo"), bounds_of("hi")))
    radius_factor = chi_square_quantile(confidence, dims)
    data = placed.select("leaf", "embedding", "ids")

    def answer(key, left, right):
        import pyarrow as pa

        out: tuple[list, list, list, list] = ([], [], [], [])
        if left.num_rows and right.num_rows:
            g = tree.value[0]
            e = matrix(left["embedding"], width)
            norm = np.sqrt((e * e).sum(axis=1))
            ids = left["ids"].to_pylist()
            index = Tree(unit(e) @ g)
            smallest = np.array([i[0] for i in ids])
            for query, v, bound in zip(right["q"].to_pylist(), matrix(right["embedding"], width), right["bound"].to_pylist(), strict=True):
                vn = math.sqrt((v * v).sum())
                best: list = [np.zeros(0, dtype=np.int64), np.zeros(0), bound]

                def verify(at, v=v, vn=vn, best=best, bound=bound):
                    s = np.concatenate([best[1], (e[at] * v).sum(axis=1) / (norm[at] * vn)])
                    at = np.concatenate([best[0], at])
                    keep = np.lexsort((smallest[at], -s))[: k + 1]
                    best[0], best[1] = at[keep], s[keep]
                    if len(keep) > k:
                        best[2] = min(bound, max(0.0, 2 - 2 * float(best[1][-1])) + 1e-12)

                index.search((v / vn) @ g, verify, lambda best=best: radius_factor * best[2])
                found = [(i, s) for at, s in zip(best[0].tolist(), best[1].tolist(), strict=True) for i in ids[at]]
                for i, s in found or [(None, None)]:
                    for c, x in zip(out, (query, i, s, best[2]), strict=True):
                        c.append(x)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.float64(), pa.float64()), strict=True)], names=["q", "vec_id", "score", "bound"])

    def visit(only_home: bool):
        def run(batches):
            import pyarrow as pa

            g, root, nodes = tree.value
            at, low, high = boxes.value
            for b in batches:
                p = unit(matrix(b.column("embedding"), width)) @ g
                home = leaf_of(p, root, nodes)
                if only_home:
                    yield pa.RecordBatch.from_arrays([pa.array(home), *b.columns], names=["leaf", *b.schema.names])
                    continue
                reach = radius_factor * b.column("bound").to_numpy()
                go, who = [], []
                for j in range(len(p)):
                    d = np.maximum(0.0, np.maximum(low - p[j], p[j] - high))
                    go.append(at[((d * d).sum(axis=1) <= reach[j]) & (at != home[j])])
                    who.append(np.full(len(go[-1]), j))
                    if sum(map(len, who[-64:])) > 4096 or j == len(p) - 1 or len(who) == 64:
                        rows = pa.array(np.concatenate(who))
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(go)), *[c.take(rows) for c in b.columns]], names=["leaf", *b.schema.names])
                        go, who = [], []

        return run

    schema, to_leaf = "q string, vec_id long, score double, bound double", "leaf long, q string, embedding array<double>, bound double"
    # Queries of equal vectors, known by 128 bits of hash, are one search.
    name = F.concat(F.hex(F.xxhash64("embedding")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), F.col("embedding"))))
    named = queries.select("query_id", name.alias("q"), "embedding")
    searches = named.select("q", "embedding").dropDuplicates(["q"])
    start = searches.withColumn("bound", F.lit(4.0)).mapInArrow(visit(True), to_leaf)
    home, _ = common.written(data.groupBy("leaf").cogroup(start.groupBy("leaf")).applyInArrow(answer, schema), "home")
    bounds = home.groupBy("q").agg(F.min("bound").alias("bound"))
    again = searches.join(bounds, "q", "left").select("q", "embedding", F.coalesce("bound", F.lit(4.0)).alias("bound"))
    rest = data.groupBy("leaf").cogroup(again.mapInArrow(visit(False), to_leaf).groupBy("leaf")).applyInArrow(answer, schema)
    found = home.unionByName(rest).where("vec_id is not null").select("q", "vec_id", "score")
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= 2 * k + 1)
    pairs = named.select("query_id", "q").join(best, "q").where("vec_id <> query_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
