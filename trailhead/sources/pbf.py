"""Map extracts in the binary format: a file of blobs, each some thousand nodes or ways as protocol buffers.

A file is cut into its blobs where it lies, the blobs are dealt out and decoded; dense numbers are decoded as arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ELEMENT = "kind string, id long, lat double, lon double, refs array<bigint>, tags map<string,string>"


def fields(data):
    """(number, value) of a message's fields; whole numbers, or bytes (a memoryview)."""
    at, end = 0, len(data)

    def number():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < end:
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        elif key & 7 == 2:
            size = number()
            yield key >> 3, data[at : at + size]
            at += size
        else:  # fixed-width numbers, which nothing here uses
            at += 8 if key & 7 == 1 else 4


def numbers(data, signed: bool = False, running: bool = False):
    """The whole numbers of a packed field; ``signed`` ones are zigzag, ``running`` ones are differences."""
    import numpy as np

    a = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(a < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    size, out = ends - starts + 1, np.zeros(len(ends), np.uint64)
    for k in range(int(size.max(initial=0))):
        on = size > k
        out[on] |= (a[starts[on] + k].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * k)
    out = (out >> np.uint64(1)).astype(np.int64) ^ -(out & np.uint64(1)).astype(np.int64) if signed else out.astype(np.int64)
    return np.cumsum(out) if running else out


def blobs(data):
    """The data blobs of a file."""
    at = 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        head = dict(fields(data[at + 4 : at + 4 + size]))
        at += 4 + size
        if bytes(head[1]) == b"OSMData":
            yield bytes(data[at : at + head[3]])
        at += head[3]


def decoded(blob: bytes):
    """(kind, id, lat, lon, refs, tags) of a blob's nodes and ways."""
    import zlib

    parts = dict(fields(memoryview(blob)))
    if 1 not in parts and 3 not in parts:
        raise ValueError("a blob is compressed in a way other than zlib")
    block = memoryview(bytes(parts[1]) if 1 in parts else zlib.decompress(parts[3]))
    texts, groups, step, south, west = [], [], 100, 0, 0
    for n, v in fields(block):
        if n == 1:
            texts = [bytes(s).decode() for k, s in fields(v) if k == 1]
        elif n == 2:
            groups.append(v)
        elif n == 17:
            step = v
        elif n == 19:
            south = v if v < 1 << 63 else v - (1 << 64)
        elif n == 20:
            west = v if v < 1 << 63 else v - (1 << 64)
    degrees = lambda x, offset: 1e-9 * (offset + step * x)
    tags_of = lambda f: [(texts[k], texts[v]) for k, v in zip(numbers(f.get(2, b"")), numbers(f.get(3, b"")), strict=True)]
    zigzag = lambda v: (v >> 1) ^ -(v & 1)
    for group in groups:
        for n, v in fields(group):
            if n == 1:
                f = dict(fields(v))
                yield "node", zigzag(f[1]), degrees(zigzag(f[8]), south), degrees(zigzag(f[9]), west), None, tags_of(f)
            elif n == 2:
                f = dict(fields(v))
                ids, lats, lons = (numbers(f[k], True, True).tolist() for k in (1, 8, 9))
                said = iter(numbers(f.get(10, b"")).tolist())
                for i, lat, lon in zip(ids, lats, lons, strict=True):
                    tags = []
                    while k := next(said, 0):
                        tags.append((texts[k], texts[next(said)]))
                    yield "node", i, degrees(lat, south), degrees(lon, west), None, tags
            elif n == 3:
                f = dict(fields(v))
                yield "way", f[1], None, None, numbers(f.get(8, b""), True, True).tolist(), tags_of(f)


def elements(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """Nodes and ways of the extracts at ``path``.  A file is held whole by the task that cuts it, its blobs by many."""

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for data in batch.column("content"):
                for blob in blobs(memoryview(data.as_py())):
                    yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["blob"])

    def decode(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.map_(pa.string(), pa.string())]
        names = ["kind", "id", "lat", "lon", "refs", "tags"]
        for batch in batches:
            for blob in batch.column("blob"):
                rows = list(decoded(blob.as_py()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(cut, "blob binary")
    return found.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(decode, ELEMENT)
