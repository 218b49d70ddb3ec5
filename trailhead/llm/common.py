"""Helpers shared by the training-data operators: the shared folder, written tables, clash-free columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session on one machine (master ``local[...]``) may leave it unset; it then gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='trailhead-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/trailhead/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it again; this cuts the lineage.  Returns the path too."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_bucket(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id lies in bucket 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds), F.lit(0))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def input_bytes(df: DataFrame) -> int:
    """What Spark expects ``df`` to hold, from the sizes of its files; nothing is read for it."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if n < 1 << 55 else 0  # unknown sizes are given as enormous


def slices(batch, column: str = "text", most_bytes: int = 1 << 21):
    """Slices of an Arrow batch whose ``column`` holds at most ``most_bytes`` (or one row), so that work on one is bounded."""
    import numpy as np
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most_bytes, side="right")))
        yield batch.slice(at, end - at)
        at = end


_KEPT: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What a Python worker keeps between the tasks of one operator (tokenizers, memos)."""
    return _KEPT.setdefault(owner, {})


def trim() -> None:
    """Gives memory that is free in this process back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def frugal(owner: str, run):
    """``run`` (a function of Arrow batches) for workers that Spark reuses: what other operators kept in the worker is
    dropped when it begins, and free memory is given back when it ends."""

    def wrapped(batches):
        from trailhead.llm import common

        if common._KEPT.keys() - {owner}:
            for other in common._KEPT.keys() - {owner}:
                del common._KEPT[other]
            common.trim()
        try:
            yield from run(batches)
        finally:
            common.trim()

    return wrapped
