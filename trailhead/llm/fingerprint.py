"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

A text's words (split at white space, lower case) give shingles of ``width`` words, or one of all words if it has
fewer.  Each shingle is hashed once to 64 bits; the top bits name its bin and the least hash of a bin stands for it.
An empty bin takes the value of the first filled bin in a pseudo-random order of its own (optimal densification), and
the low ``BITS`` bits of every bin (of its value hashed with its number) are packed.  The share of equal bins, corrected for chance equality
(2 ** -BITS), estimates the Jaccard similarity of the shingle sets.

Everything happens within a row; a fingerprint is 64 hex digits for each 64 bins.  Defined cases: a null or empty text,
or one of white space only, has the empty fingerprint, alike (1) to itself and unlike (0) all others; equal texts have
equal fingerprints; very long texts count whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailhead.llm import common

LOG_BINS = 8
BINS = 1 << LOG_BINS
BITS = 4
PROBES = 8


def _mixed(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % (1 << 64)
    return x ^ (x >> 31)


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def packed(text: str, width: int = 5) -> Column:
    """array<bigint> of packed bins for the text in column ``text``."""
    first = ",".join(str(_mixed(k + 1) % BINS) for k in range(BINS))
    step = ",".join(str(_mixed(k + 1 + BINS) % BINS | 1) for k in range(BINS))
    bin_of = f"cast(shiftright({{0}}, {64 - LOG_BINS}) + {BINS // 2} as int)"
    at = f"dense[(array({first})[k] + {{0}} * array({step})[k]) & {BINS - 1}]"
    words = f"filter(split(lower({text}), '\\\\s+'), x -> x <> '')"
    hashes = f"transform(sequence(1, greatest(size(words) - {width - 1}, 1)), i -> xxhash64(slice(words, i, {width})))"
    least = f"filter(sorted, (x, i) -> i = 0 or {bin_of.format('x')} <> {bin_of.format('sorted[i - 1]')})"
    dense = (
        f"concat(array_repeat(cast(null as bigint), {bin_of.format('least[0]')}), flatten(transform(least, (x, i) -> concat(array(x), "
        f"array_repeat(cast(null as bigint), if(i + 1 < size(least), {bin_of.format('least[i + 1]')}, {BINS}) - {bin_of.format('x')} - 1)))))"
    )
    rest = f"aggregate(sequence({PROBES}, {BINS - 1}), cast(null as bigint), (found, t) -> coalesce(found, {at.format('t')}))"
    full = f"transform(dense, (x, k) -> coalesce(x, {', '.join(at.format(t) for t in range(PROBES))}, {rest}))"
    filled = f"if(size(least) = {BINS}, least, if(size(least) = 1, array_repeat(least[0], {BINS}), {_let(dense, 'dense', full)}))"
    per = 64 // BITS
    # A value that fills several bins is hashed with each bin's number, so that chance equality is chance in every bin.
    low = f"transform(full, (x, k) -> xxhash64(x, k) & {(1 << BITS) - 1})"
    pack = _let(low, "low", f"transform(sequence(0, {BINS // per - 1}), j -> aggregate(slice(low, j * {per} + 1, {per}), 0L, (a, x) -> shiftleft(a, {BITS}) | x))")
    body = _let(f"sort_array({hashes})", "sorted", _let(least, "least", _let(filled, "full", pack)))
    return F.expr(_let(f"coalesce({words}, array())", "words", f"if(size(words) = 0, cast(array() as array<bigint>), {body})"))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints (column names), without the bias of equal low bits."""
    low = "1229782938247303441"  # 0x1111111111111111: the low bit of each bin's four
    one = f"bit_count((y | shiftright(y, 1) | shiftright(y, 2) | shiftright(y, 3)) & {low}L)"
    differ = f"aggregate(zip_with({a}, {b}, (p, q) -> p ^ q), 0, (n, y) -> n + cast({one} as int))"
    corrected = f"greatest(0.0D, (1.0D - {differ} / {BINS}D - {2.0**-BITS}D) / {1 - 2.0**-BITS}D)"
    return F.expr(f"case when size({a}) = 0 and size({b}) = 0 then 1.0D when size({a}) = 0 or size({b}) = 0 then 0.0D else {corrected} end")


def fingerprints(docs: DataFrame, text: str = "text", width: int = 5) -> DataFrame:
    """``docs`` with ``fingerprint`` (text)."""
    return docs.withColumn("fingerprint", as_text(packed(text, width)))


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text, fp of every row, and next_text, next_fp of the row after it in descending (doc_id, text), the last's being the first's.

    Rows go to ranges of doc_id (a range per bucket, bounds from quantiles of the ids) and are put in order within each;
    the last of a range takes the first row of the next range that has rows.  Texts are shuffled once.  Null ids come last.
    """
    spark = docs.sparkSession
    n = buckets or min(2048, 4 * common.partitions(spark))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = sorted(set(docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [k / n for k in range(1, n)], 0.1 / n))) if n > 1 else []
    bound = "array({})".format(",".join(f"{int(c)}L" for c in cuts)) if cuts else "cast(array() as array<bigint>)"
    bucket = F.expr(f"if(doc_id is null, -1, size(filter({bound}, b -> b <= doc_id)))").alias("bucket")
    keyed = rows.select("doc_id", "text", bucket)
    made = keyed.withColumn("fp", packed("text"))
    w = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), F.desc("text"))
    inner = made.select("*", F.lead("text").over(w).alias("next_text"), F.lead("fp").over(w).alias("next_fp"), F.lead(F.lit(True), 1, False).over(w).alias("has_next"))
    # One row per bucket from here: its first row, given to the bucket before it in the order.
    heads = keyed.groupBy("bucket").agg(F.max(F.struct("doc_id", "text")).alias("head"))
    ids = heads.select("bucket")
    ring = Window.orderBy(F.desc("bucket"))
    after = ids.select("bucket", F.coalesce(F.lead("bucket").over(ring), F.first("bucket").over(ring)).alias("after"))
    first = after.join(heads.select(F.col("bucket").alias("after"), "head"), "after").select("bucket", F.col("head.text").alias("head_text")).withColumn("head_fp", packed("head_text"))
    joined = inner.join(first.hint("merge"), "bucket")
    pick = lambda a, b: F.when(F.col("has_next"), F.col(a)).otherwise(F.col(b)).alias(a)
    return joined.select("doc_id", "text", "fp", pick("next_text", "head_text"), pick("next_fp", "head_fp"))


def edited(docs: DataFrame) -> DataFrame:
    """The contract's rows: fingerprints of each text, of its edited text, and their likenesses."""
    third = "cast(floor(n_chars / 3) as int)"
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr(f"concat(substring(text, 1, cast(n_chars as int) - {third}), substring(next_text, 1, {third}))"))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), packed("edited").alias("edited_fp"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"),
    )
