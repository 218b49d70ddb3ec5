"""Token-ID output: Parquet list columns, selective reads.

``write_tokens`` lays out one row per document in ascending ``doc_id`` order (null ids first, ties by where they are read, then by text):

* ``shard``, ``row``: number of the file's range and the row in it; ``start``: ids before the row in its shard,
* ``n_tokens``: ids of the document with its end id; ``ids``: ``list<int>``.

``ids`` is dictionary-encoded (16 bits an id for a vocabulary under 65,536, bit-packed) or, with ``encoding="delta"``,
DELTA_BINARY_PACKED.  Row groups and pages are of a set size; Parquet's column and offset indexes are written, so a
filter on ``doc_id`` skips pages, and reading ``n_tokens`` alone never touches the ids.

Defined cases: null text counts as empty (its only id is the end id); an empty table gives no rows; further columns
of the input, whatever their names, are ignored; repeated rows are each written; very long texts are one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailhead.llm import common, tokens

SCHEMA = "doc_id long, shard int, row long, start long, n_tokens long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, encoding: str = "dictionary", row_group_mb: int = 16, page_kb: int = 64, shard_mb: int = 256, shards: int | None = None) -> None:
    """Encode every whole text and write the ids to ``path``, by ranges of ``doc_id``.

    Only the texts are shuffled, once, and before they are encoded, so that the sampling of the ranges encodes nothing.
    There are as many ranges as keep a shard near ``shard_mb`` of the input's files (or ``spark.sql.shuffle.partitions``, if
    more).  Rows of one id are ranged by the input partition they are read from, so that no id is too large for a task; the
    sampling of the ranges reads ids only.  A task holds one Arrow batch of texts and ids.
    """

    def encode(rows):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard, row, start = TaskContext.get().partitionId(), 0, 0
        encode = tokens.encoder(tokenizer, end_id).encode
        for batch in rows:
            for ids, texts in tokens.batches(batch.column("text"), batch.column("doc_id")):
                made = encode(texts)
                n = np.fromiter((len(x) // 4 for x in made), dtype=np.int64, count=len(made))
                ends = np.cumsum(n)
                flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(made))])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.full(len(n), shard), pa.int32()), pa.array(row + np.arange(len(n))), pa.array(start + ends - n), pa.array(n), lists],
                    names=["doc_id", "shard", "row", "start", "n_tokens", "ids"],
                )
                row, start = row + len(n), start + int(ends[-1])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.spark_partition_id().alias("at"))
    shards = shards or max(common.partitions(docs.sparkSession), common.input_bytes(docs) // (shard_mb << 20) + 1)
    ranged = rows.repartitionByRange(shards, "doc_id", "at").sortWithinPartitions("doc_id", "at", "text").select("doc_id", "text")
    options = {
        "compression": "zstd", "parquet.block.size": str(row_group_mb << 20), "parquet.page.size": str(page_kb << 10), "parquet.page.write-checksum.enabled": "true",
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(), "parquet.dictionary.page.size": str(1 << 20), "parquet.writer.version": "PARQUET_2_0", "parquet.column.index.truncate.length": "64",
    }
    ranged.mapInArrow(common.frugal("tokens", encode), SCHEMA).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of the written files; name ``columns`` to leave the ids, or the metadata, on disk."""
    found = spark.read.schema(SCHEMA).parquet(path)
    return found.select(*columns) if columns else found


def with_starts(spark: SparkSession, path: str) -> DataFrame:
    """All columns, ``start`` counted over the whole corpus.  Only a row per shard is summed in one place."""
    base = shard_starts(read_tokens(spark, path, ["shard", "n_tokens"]))
    return read_tokens(spark, path).join(F.broadcast(base), "shard").withColumn("start", F.col("start") + F.col("shard_start")).drop("shard_start")


def shard_starts(lengths: DataFrame) -> DataFrame:
    """Ids before each shard.  There are as many shards as files, so this small table may be broadcast."""
    from pyspark.sql import Window

    sums = lengths.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return sums.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of rows read back: crc32 of the ids as little-endian unsigned 32-bit integers."""

    def crc(rows):
        import zlib

        import pyarrow as pa

        for batch in rows:
            lists = batch.column("ids")
            cuts, raw = lists.offsets.to_numpy() * 4, memoryview(lists.values.to_numpy().astype("<i4", copy=False)).cast("B")
            crcs = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            n = pa.array((cuts[1:] - cuts[:-1]) // 4, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), n, pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return found.select("doc_id", "start", "ids").mapInArrow(common.frugal("tokens", crc), "doc_id long, start long, n_tokens long, ids_crc32 long")
