"""Exact n-gram Jaccard join of documents, by a size-aware heavy-light scheme, and the components of its links.

A document's set holds the 64-bit hashes of its distinct shingles.  Two documents link if
``100 * intersection >= percent * union``.  Sets so alike share, in any common order of the shingles, at least ``c`` of
their first ``n - ceil(t * n) + c``.  So

* a light (small) set is entered under every pair of shingles of its prefix for c = 2 (fixed-size subsets),
* a heavy (large) set is entered under each shingle of its prefix for c = 1, an inverted list to be scanned,

and sets just above the boundary are entered both ways to meet the light ones.  The boundary is the size at which the
estimated cost, entries plus scanned entries, of the corpus is least; it comes from the sizes' histogram and the mean
length of inverted lists.  The common order puts a fixed share of all hash values, somewhat more than a prefix, first,
and among these the shingles of only one class, which need no list, then the rarer; so counts of that share alone are
gathered, and most documents have no list at all.  The order affects speed, not the links.

Shingles and classes are known by 64 bits of a digest, so results are exact but for hash collisions: among ``n`` different
sets the number of wrong classes to expect is n * n / 2**65 (for 5 * 10**10 documents about 70).

Only connectivity is wanted, so not all pairs of a list are made.  Equal sets are one class.  Then

1. every class of a list is compared with the list's leader, the class whose shingle stands first in its own order;
2. lists whose classes are already connected need nothing more;
3. in the others, classes not yet connected are compared exactly: short lists by a join, long ones in blocks of
   bounded size, where only links between different components are kept.

No list is capped or sampled, and sets are fetched only for classes that share a list, from one row of each.  Words are cut and hashed in
Python on Arrow batches; joins, verification, and components (large-star / small-star) are DataFrame operations over
written tables.

Defined cases: null or empty text and text without words have an empty set and link with nothing; a text of fewer words
than ``width`` has its whole word sequence as its one shingle; very long texts count whole; repeated rows and ids are kept,
one result row each, each text judged by itself; a null doc_id stays null and names no component if another id is there, but
its text links like any other; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailhead.llm import common

WORD_MEMO = 1 << 17
SHORT_LIST = 16
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1 << 20


class Shingler:
    """Sorted arrays of 64-bit shingle hashes of texts (UTF-8 bytes)."""

    def __init__(self, width: int):
        self.width, self.memo = width, {}

    def words(self, text: bytes) -> list[bytes]:
        return text.lower().split()  # bytes: A-Z only, and the six characters \x20 \x09-\x0D

    def set_of(self, text: bytes | None):
        import numpy as np
        import xxhash

        words = self.words(text or b"")
        memo = self.memo
        fresh = {w for w in words if w not in memo}
        if fresh:
            if len(memo) > WORD_MEMO:
                memo.clear()
                fresh = set(words)
            for w in fresh:
                memo[w] = xxhash.xxh64_intdigest(w)
        if not words:
            return np.zeros(0, dtype=np.int64)
        h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.width, len(h))
        n = len(h) - width + 1
        a = np.full(n, width, dtype=np.uint64)
        for j in range(width):
            a = (a ^ h[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            a ^= a >> np.uint64(29)
        return np.unique((a * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64))


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares at least with any set it links to."""
    return -(-percent * n // 100)


def prefix(n: int, percent: int, c: int) -> int:
    return min(n, n - least_overlap(n, percent) + c)


def boundary(sizes: dict[int, int], list_length: float, percent: int) -> int:
    """The greatest size of a light set: the one with the least total of entries and scanned entries."""
    light = lambda n: (p := prefix(n, percent, 2)) * (p - 1) / 2
    heavy = lambda n: prefix(n, percent, 1) * (1 + list_length)
    order = sorted(sizes)
    cost = sum(sizes[n] * heavy(n) for n in order)
    best, at = cost, 0
    for n in order:
        cost += sizes[n] * (light(n) - heavy(n))
        if cost < best:
            best, at = cost, n
    return at


def digest(shingles) -> int:
    """The class of a set: 64 bits of its digest."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def numbers(lists: list):
    """An Arrow list column of numpy arrays of 64-bit integers."""
    import numpy as np
    import pyarrow as pa

    cuts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *lists]), pa.int64()))


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id, h (64 bits of the text's hash; with the id it tells rows apart), text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def entries(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, h, n, class (64 bits of the set's digest; null if empty) of every row, the shingles of the set's early region and,
    if those may not fill the prefix, the first ones (``late``) of the rest.

    The early region is a share of all hash values, somewhat larger than a prefix: the same for all sets.  Work is done,
    and handed on, for slices of bounded bytes (or one row)."""
    import numpy as np

    share = min(1.0, (100 - percent) / 60)
    bound = np.uint64(int(share * (2**64 - 1)))

    def run(rows):
        import pyarrow as pa

        make = Shingler(width)
        for batch in (part for whole in rows for part in common.slices(whole)):
            n, number, early, late = [], [], [], []
            for t in batch.column("text").cast(pa.binary()):
                s = make.set_of(t.as_py())
                first = s.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) <= bound
                x = s[first] if len(s) > 1 else s[:0]
                n.append(len(s))
                number.append(digest(s) if len(s) else None)
                early.append(x)
                late.append(np.sort(s[~first])[: max(0, prefix(len(s), percent, 2) - len(x))] if len(s) > 1 else s[:0])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(n, pa.int64()), pa.array(number, pa.int64()), numbers(early), numbers(late)], names=["doc_id", "h", "n", "class", "early", "late"])

    return texts.mapInArrow(common.frugal("shingles", run), "doc_id long, h long, n long, class long, early array<long>, late array<long>")


def lists_of(rows: DataFrame, percent: int) -> tuple[DataFrame, str, int]:
    """A written table of k, class, n, p, its path, and the greatest light size: the keys of the classes' prefixes that more than one class may share, and the key's place in the order.

    The order of shingles: those of the early region before the others; in it, those of one class only first (they are in
    no list), the rest by their count; then by hash.  Only the shingles of the early region are shuffled."""
    early = rows.select("class", "n", F.size("early").alias("r"), F.explode("early").alias("t"), F.lit(-1).alias("late"))
    late = rows.select("class", "n", F.size("early").alias("r"), F.posexplode("late").alias("late", "t")).select("class", "n", "r", "t", "late")
    all_ = early.unionByName(late)
    shared = all_.groupBy("t").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.count("*").alias("df")).where("a <> b").select("t", "df")
    shared, shared_path = common.written(shared, "shared")
    # Size histogram, in steps of a sixteenth, and the mean length of the lists that are scanned: they set the boundary.
    step = F.expr("if(n < 64, n, cast(n div cast(pow(2, floor(log2(n)) - 4) as bigint) * cast(pow(2, floor(log2(n)) - 4) as bigint) as bigint))")
    sizes = {r["s"]: r["n"] for r in rows.where("n > 1").groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()}
    length = shared.where("df < 32").agg((F.sum(F.col("df").cast("double") * F.col("df")) / F.sum("df")).alias("x")).first()["x"] or 1.0
    light = boundary(sizes, length, percent)
    order = F.struct((F.col("late") >= 0).alias("after"), F.when(F.col("late") >= 0, F.col("late").cast("long")).otherwise(F.col("df")).alias("rank"), "t")
    sets = all_.join(shared, "t").groupBy("class", "n", "r").agg(F.sort_array(F.collect_set(order)).alias("m"))
    sets = sets.withColumn("alone", F.expr("r - size(filter(m, x -> not x.after))"))
    place = F.expr("transform(m, (x, i) -> struct(if(x.after, r + x.rank, alone + i) as p, x.t as t))")
    least = f"(({percent} * n + 99) div 100)"
    single = f"if(n > {light}, transform(filter(m, x -> x.p < n - {least} + 1), x -> struct(xxhash64(x.t) as k, x.p as p)), array())"
    double = f"""if(n <= {light * 100 // percent}, flatten(transform(filter(m, x -> x.p < n - {least} + 2), x -> transform(filter(m, y -> y.p < n - {least} + 2 and y.p > x.p),
                 y -> struct(xxhash64(least(x.t, y.t), greatest(x.t, y.t)) as k, x.p as p)))), array())"""
    keyed = sets.withColumn("m", place).select("class", "n", F.expr(f"explode(concat({single}, {double}))").alias("e"))
    made, path = common.written(keyed.select("e.k", "class", "n", F.col("e.p").cast("long").alias("p")), "keys")
    common.remove(rows.sparkSession, shared_path)
    return made, path, light


def same_row(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, h) whose id (null equals null) and h are in ``chosen``, with chosen's further columns."""
    key = lambda: [F.coalesce("doc_id", F.lit(0)).alias("id0"), F.col("doc_id").isNull().alias("no_id"), F.col("h").alias("h0")]
    right = chosen.select(*key(), *[c for c in chosen.columns if c not in ("doc_id", "h")])
    return docs.select(*docs.columns, *key()).join(right, ["id0", "no_id", "h0"])


def first_rows(rows: DataFrame, group: str) -> DataFrame:
    """Of each ``group``: doc_id and h of its first row, by id (null last) and h, and ``copies``, the rows alike in both."""
    alike = rows.groupBy(group, "doc_id", "h").agg(F.count("*").alias("copies"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "copies"))
    return alike.groupBy(group).agg(least.alias("r")).select(group, "r.doc_id", "r.h", "r.copies")


def sets_of(texts: DataFrame, wanted: DataFrame, width: int) -> tuple[DataFrame, str]:
    """A written table of class and shingles of the wanted classes, each from the row that ``wanted`` (class, doc_id, h, copies) names."""

    def run(rows):
        import pyarrow as pa

        make = Shingler(width)
        for batch in (part for whole in rows for part in common.slices(whole)):
            sets = [make.set_of(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("class"), batch.column("copies"), numbers(sets)], names=["class", "copies", "shingles"])

    found = same_row(texts, wanted).select("class", "copies", "text").mapInArrow(common.frugal("shingles", run), "class long, copies long, shingles array<long>")
    made, path = common.written(found, "sets")
    # Only rows that are there several times need to be reduced to one, so most sets are not shuffled for it.
    once = made.where("copies = 1").unionByName(made.where("copies > 1").dropDuplicates(["class"]))
    return once.select("class", "shingles"), path


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of classes that link."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(right, "b").join(left, "a").withColumn("i", F.size(F.array_intersect("x", "y")))
    return both.where(F.lit(100) * F.col("i") >= F.lit(percent) * (F.size("x") + F.size("y") - F.col("i"))).select("a", "b")


def stars(links: DataFrame) -> DataFrame:
    """Components of links (a, b): node and label, the least node of its component; nodes without links are left out."""
    spark = links.sparkSession
    edges, path = common.written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        edges, new = common.written(small.distinct(), "links")
        common.remove(spark, path)
        path = new


def in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different labels among the classes of each (k, i, j), one for each joining of labels."""

    def run(key, table):
        import numpy as np
        import pyarrow as pa

        owners, labels = table["class"].to_pylist(), table["label"].to_pylist()
        column = table["shingles"].combine_chunks()
        cuts = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
        n = np.diff(cuts)
        token, inverse, count = np.unique(column.flatten().to_numpy(), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(n)), n)
        place = np.cumsum(count > 1) - 1
        use = count[inverse] > 1
        owner, inverse = owner[use], place[inverse[use]]
        order = np.argsort(inverse, kind="stable")
        owner, inverse = owner[order], inverse[order]
        common_ = np.zeros((len(n), len(n)), dtype=np.float32)
        for at in range(0, int(inverse[-1]) + 1 if len(inverse) else 0, 1024):
            low, high = np.searchsorted(inverse, [at, at + 1024])
            x = np.zeros((len(n), 1024), dtype=np.float32)
            x[owner[low:high], inverse[low:high] - at] = 1
            common_ += x @ x.T
        name = {x: k for k, x in enumerate(dict.fromkeys(labels))}
        group = np.array([name[x] for x in labels])
        parent = list(range(len(name)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        a, b = [], []
        for at in range(0, len(n), 128):  # some rows of the matrix at a time, for its comparison takes much more room than itself
            rows_ = slice(at, at + 128)
            inter = common_[rows_].astype(np.int64)
            link = (100 * inter >= percent * (n[rows_, None] + n[None, :] - inter)) & (group[rows_, None] != group[None, :])
            i, j = np.nonzero(np.triu(link, at + 1))
            for x, y in zip((i + at).tolist(), j.tolist(), strict=True):
                p, q = root(group[x]), root(group[y])
                if p != q:
                    parent[p] = q
                    a.append(owners[x])
                    b.append(owners[y])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def tidy(key, table):
        try:
            return run(key, table)
        finally:
            common.trim()

    return rows.groupBy("k", "i", "j").applyInArrow(lambda key, table: tidy(key, table), "a long, b long")


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, h, n_shingles, class (64 bits of the set's digest; null if empty), label (the component's least class; null if empty)."""
    spark = docs.sparkSession
    texts = texts_of(docs)
    rows, rows_path = common.written(entries(texts, width, percent), "entries")
    keys, keys_path, light = lists_of(rows.where("class is not null"), percent)
    keyed = keys.select("k", F.struct("p", "class", "n").alias("x"))
    # Tables of lists are written before they meet their entries, so that a list with very many entries can be split among tasks.
    lists = keyed.groupBy("k").agg(F.min("x").alias("leader"), F.max("x").alias("other")).where("leader.class <> other.class").select("k", "leader")
    lists, leaders_path = common.written(lists, "leaders")
    shared, shared_path = common.written(keyed.join(lists, "k").select("k", "x.class", "x.n", "x.p", "leader"), "lists")
    common.remove(spark, keys_path, leaders_path)
    wanted = first_rows(rows.select("class", "doc_id", "h").join(shared.select("class").distinct(), "class", "left_semi"), "class")
    sets, sets_path = sets_of(texts, wanted, width)

    near = f"100 * least({{0}}, {{1}}) >= {percent} * greatest({{0}}, {{1}})"
    # If this is the first shingle two sets share, at most the rest of either is shared.
    reach = f"(100 + {percent}) * least({{0}} - {{2}}, {{1}} - {{3}}) >= {percent} * ({{0}} + {{1}})"
    first = shared.where("class <> leader.class").where(near.format("n", "leader.n")).where(reach.format("n", "leader.n", "p", "leader.p"))
    links, links_path = common.written(verified(first.select(F.col("leader.class").alias("a"), F.col("class").alias("b")).distinct(), sets, percent), "pairs")

    labels = stars(links)
    marked = shared.select("k", "class", "n", "p").distinct().join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    marked, marked_path = common.written(marked, "marked")

    def open_lists(found: DataFrame) -> DataFrame:
        """Entries of lists whose classes are not all connected, with the list's members and weight; in lists of sizes, of the
        band that gives the list its name some member must be."""
        lists = found.groupBy("k").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"), F.sum("n").alias("weight"), F.max(F.col("own") == F.col("v")).alias("met"))
        lists, path = common.written(lists.where("low <> high and met").select("k", "members", "weight"), "open")
        open_paths.append(path)
        return found.join(lists, "k")

    open_paths: list[str] = []
    undone, undone_path = common.written(open_lists(marked.withColumn("own", F.lit(0)).withColumn("v", F.lit(0))), "undone")
    # Long lists that share their busiest class become one, so that a group of near copies is one list, not one per shingle.
    # Each falls apart by size: linked sets lie in one band of sizes or in neighbouring ones, and meet in the list of the upper.
    long_ = undone.where(F.col("members") > SHORT_LIST).select("k", "class", "n", "label")
    busy = long_.join(long_.groupBy("class").agg(F.count("*").alias("lists")), "class")
    heads = busy.groupBy("k").agg(F.max(F.struct("lists", "class")).alias("head")).select("k", F.col("head.class").alias("head"))
    heads, heads_path = common.written(heads, "heads")
    open_paths.append(heads_path)
    merged = long_.join(heads, "k").select("head", "class", "n", "label").distinct()
    band = F.expr(f"cast(floor(ln(n) / ln({100.1 / percent}D)) as int)")
    banded = merged.withColumn("own", band).withColumn("v", F.explode(F.array("own", F.col("own") + 1)))
    banded, banded_path = common.written(open_lists(banded.select(F.xxhash64("head", "v").alias("k"), "class", "n", "label", "own", "v")), "banded")
    short = undone.where(F.col("members") <= SHORT_LIST)
    a, b = short.alias("a"), short.alias("b")
    met = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.class") < F.col("b.class")) & (F.col("a.label") != F.col("b.label")) & F.expr(near.format("a.n", "b.n")))
    met = met.groupBy(F.col("a.class").alias("a"), F.col("b.class").alias("b")).agg(F.count("*").alias("j"), F.min("a.n").alias("na"), F.min("b.n").alias("nb"), F.min("a.p").alias("pa"), F.min("b.p").alias("pb"))
    # Large sets that link share, besides j shingles of their prefixes, at most what lies behind the prefix of one of them.
    # A pair that also shares a long list is compared there, so here j and the first places are those of all lists.
    enough = f"least(na, nb) <= {light * 100 // percent} or j + greatest(({percent} * na + 99) div 100, ({percent} * nb + 99) div 100) - 1 >= ({percent} * (na + nb) + {99 + percent}) div {100 + percent}"
    pairs = met.where(enough).where(reach.format("na", "nb", "pa", "pb")).select("a", "b")
    long_ = banded.drop("own").withColumn("blocks", F.expr(f"cast(greatest(ceil(members / {BLOCK_CLASSES}), ceil(weight / {BLOCK_SHINGLES})) as int)"))
    long_ = long_.withColumn("own", F.pmod(F.xxhash64("class"), "blocks")).select("k", "class", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    long_ = long_.select("k", "class", "label", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    more = verified(pairs, sets, percent).unionByName(in_blocks(long_.join(sets, "class").select("k", "i", "j", "class", "label", "shingles"), percent))
    final = stars(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))
    common.remove(spark, shared_path, links_path, marked_path, undone_path, banded_path, sets_path, *open_paths)
    out = rows.select("doc_id", "h", F.col("n").alias("n_shingles"), "class").join(final.withColumnRenamed("node", "class"), "class", "left")
    return out.select("doc_id", "h", "n_shingles", "class", F.coalesce("label", "class").alias("label"))


def components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of the component)."""
    found = classes(docs, width, percent)
    least = found.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    least, _ = common.written(least, "least")  # so that a very large component can be split when it meets its rows
    return found.join(least, "label", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: of the smallest doc_id (a null one last), then of the least text hash; of rows
    alike in both, any.  Rows without words link with nothing, so all of them stay."""
    label = classes(docs, width, percent).where("label is not null").select("label", "doc_id", "h")
    first = first_rows(label, "label").select("doc_id", "h", "copies")
    own = docs.columns
    # Own columns travel in one struct, so no name of theirs can clash; the id's and the text's types stay theirs too.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.rlike(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]")).alias("words"))
    found = same_row(rows.where("words"), first)
    # Rows alike in id and text lie together by now.
    once = found.dropDuplicates(["id0", "no_id", "h0"])
    return once.select("row").unionByName(rows.where("not words").select("row")).select("row.*")
