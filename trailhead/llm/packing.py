"""Cost-balanced packing of documents into training sequences.

A document of more than ``longest`` tokens is cut into as few equal pieces as keep to that; since no sequence is then given
to one long document alone, costs stay balanced.  The pieces of a block (a bounded number of tokens of one input
partition) go, longest first, each to the sequence of lowest cost that still has room for it; the cost of a sequence is
``linear * tokens + quadratic * sum(piece length squared)``, an estimate of attention within documents.  Pieces that fit
nowhere whole are cut over the remaining room, cheapest sequence first.  The capacities of a
block add up to its tokens: whole sequences, and for what is left sequences of powers of two, which need no padding.

Nothing is shuffled: each task packs its own partition, block by block, so memory depends on ``block_tokens`` and the
longest text only.  A sequence's id holds the partition number, so a task that runs again gives the same ids.

Defined cases: null and empty texts hold the end id only; null doc_id stays null; repeated rows are packed each; ties go by
doc_id, then ids; very long texts are packed whole; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailhead.llm import common, tokens

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, sequence_cost double"


def powers(n: int) -> list[int]:
    """Powers of two that add up to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def plan(lengths: list[int], capacity: int = 2048, longest: int = 1024, linear: float = 1.0, quadratic: float = 1 / 1024) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths."""
    import numpy as np

    whole = []  # (length, document, start)
    for k, n in enumerate(lengths):
        parts = -(-n // longest)
        cuts = [n * j // parts for j in range(parts + 1)] if parts else []
        whole += [(b - a, k, a) for a, b in zip(cuts, cuts[1:], strict=False)]
    total = sum(lengths)
    size = np.array([capacity] * (total // capacity) + powers(total % capacity), dtype=np.int64)
    room, cost, pieces = size.copy(), np.zeros(len(size)), []

    def put(k: int, start: int, n: int, s: int) -> None:
        pieces.append((k, start, n, s, int(size[s] - room[s])))
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    over = []
    for n, k, start in sorted(whole, key=lambda r: (-r[0], r[1], r[2])):
        s = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[s] >= n:
            put(k, start, n, s)
        else:
            over.append((n, k, start))
    for n, k, start in over:
        while n:
            s = int(np.argmin(np.where(room > 0, cost, np.inf)))
            take = min(n, int(room[s]))
            put(k, start, take, s)
            start, n = start + take, n - take
    return pieces


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, block_tokens: int = 1 << 20, longest: int = 1024, linear: float = 1.0, quadratic: float = 1 / 1024) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, the crc32 of its ids, its sequence's tokens and cost."""

    def run(rows):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        base, used = TaskContext.get().partitionId() << 33, 0
        encode = tokens.encoder(tokenizer, end_id).encode

        def packed(ids, made):
            nonlocal used
            n = [len(x) // 4 for x in made]
            order = sorted(range(len(n)), key=lambda k: (-n[k], ids[k] is None, ids[k] or 0, made[k]))
            out, total, cost = [], {}, {}
            pieces = plan([n[k] for k in order], capacity, min(longest, capacity), linear, quadratic)
            for _, _, length, s, _ in pieces:
                total[s] = total.get(s, 0) + length
                cost[s] = cost.get(s, 0.0) + linear * length + quadratic * length * length
            for j, at, length, s, offset in pieces:
                k = order[j]
                out.append((ids[k], at, length, zlib.crc32(memoryview(made[k])[4 * at : 4 * (at + length)]), n[k], base + used + s, offset, total[s], cost[s]))
            used += len(total)
            kinds = [pa.float64() if "double" in c else pa.int64() for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        ids, made, size = [], [], 0
        for batch in rows:
            for i, t in tokens.batches(batch.column("text"), batch.column("doc_id")):
                got = encode(t)
                ids += i
                made += got
                size += sum(map(len, got))
                if size >= 4 * block_tokens:
                    yield packed(ids, made)
                    ids, made, size = [], [], 0
        if ids:
            yield packed(ids, made)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(common.frugal("tokens", run), SCHEMA)
