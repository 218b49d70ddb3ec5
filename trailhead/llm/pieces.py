"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi search.

The automaton runs once over a text; at each position it gives, along its output links, all pieces that end there, and
each relaxes the best score of that position.  A character that no piece covers costs ``least score - 10`` and is
written as its bytes' pieces (or as the unknown piece).  The result is the segmentation of the highest sum of scores,
as unigram segmentation defines it, for any vocabulary file; equal sums keep the segmentation with the longest
last piece.

If no piece has a space mark but at its beginning, the best segmentation of a text is that of its words one after the
other, and if no piece holds a line feed, lines part as well; then words are searched once and remembered (at most
``memo_words``).  Decoding concatenates the pieces' bytes.

Defined cases: null text counts as empty and has no ids; the text's own space marks (U+2581) decode as spaces, as in the
library; whole texts, very long ones too, are searched; repeated rows are encoded each; an empty table gives no rows; other
columns are kept, own columns named like the results are replaced.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from trailhead.llm import common

MARK = "▁"
MEMO_WORDS = 400_000
ROWS = 128


class Memo(dict):
    """Ids by part of a text: a word after a space, or a line feed and the word after it."""

    def __init__(self, search, feed: bytes, former: dict):
        super().__init__()
        self.search, self.feed, self.former = search, feed, former

    def __missing__(self, part: str) -> bytes:
        ids = self.former.get(part)
        if ids is None:
            ids = self.feed + self.search(part[1:]) if part[:1] == "\n" else self.search(MARK + part)
        self[part] = ids
        return ids


class Pieces:
    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        import ahocorasick
        import numpy as np
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.words = ahocorasick.Automaton()
        self.bytes_of = [b""] * n
        byte_id, scores, crossing, feeds = {}, [], False, False
        for i in range(n):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                self.words.add_word(piece, (len(piece), m.get_score(i), i))
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
                scores.append(m.get_score(i))
                crossing |= MARK in piece.lstrip(MARK)
                feeds |= "\n" in piece
        self.words.make_automaton()
        self.single = {p for p in self.words if len(p) == 1}
        self.unknown_score, self.unknown = min(scores) - 10.0, m.unk_id()
        self.fallback = byte_id if len(byte_id) == 256 else None
        self.parts = not crossing and not feeds
        self.memo_words = memo_words
        self.memo = Memo(self._viterbi, self._viterbi("\n"), {})
        self.length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.raw = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)

    def _viterbi(self, text: str) -> bytes:
        """Ids (little-endian 32-bit) of the best segmentation of a text whose spaces are marks already."""
        best, back = [0.0], [(0, 0)]

        def open_to(end: int) -> None:
            for c in text[len(best) - 1 : end + 1]:
                best.append(-math.inf if c in self.single else best[-1] + self.unknown_score)
                back.append((1, -1))

        for end, (size, score, i) in self.words.iter(text):
            if len(best) < end + 2:
                open_to(end)
            total = best[end + 1 - size] + score
            if total > best[end + 1]:
                best[end + 1], back[end + 1] = total, (size, i)
        open_to(len(text) - 1)
        ids, j = [], len(text)
        while j:
            size, i = back[j]
            if i < 0:
                ids += [self.fallback[b] for b in reversed(text[j - 1].encode())] if self.fallback else [self.unknown]
            else:
                ids.append(i)
            j -= size
        return b"".join(i.to_bytes(4, "little") for i in reversed(ids))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.parts:
            return self._viterbi(MARK + text.replace(" ", MARK))
        if len(self.memo) > self.memo_words:
            self.memo = Memo(self._viterbi, self.memo.feed, dict(self.memo))
        if "  " in text or MARK in text:  # runs of marks may be pieces: cut before each run only
            parts = re.findall(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+", MARK + text.replace(" ", MARK))
            return b"".join([self.memo.feed if p == "\n" else self._viterbi(p) for p in parts])
        return b"".join(map(self.memo.__getitem__, text.replace("\n", " \n").split(" ")))

    def decode(self, ids) -> bytes:
        """The bytes of the pieces, without the space that stands before every text."""
        import numpy as np

        size = self.length[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        text = self.raw[np.repeat(self.start[ids] - ends + size, size) + np.arange(int(ends[-1]))].tobytes()
        return text[1:] if text[:1] == b" " else text


def loaded(path: str) -> Pieces:
    """One automaton for each Python worker and file."""
    held = common.kept("pieces")
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def encoded_batches(model: str):
    """A function of Arrow batches that adds ``ids`` to rows with text."""

    def run(rows):
        import numpy as np
        import pyarrow as pa

        p = loaded(model)
        for whole in rows:
            for batch in common.slices(whole, most_bytes=1 << 19):
                made = [p.encode(t or "") for t in batch.column("text").to_pylist()]
                cuts = np.concatenate([[0], np.cumsum([len(m) // 4 for m in made])])
                flat = pa.Array.from_buffers(pa.int32(), int(cuts[-1]), [None, pa.py_buffer(b"".join(made))])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat)], names=[*batch.schema.names, "ids"])

    return run


def decoded_batches(model: str, into: str):
    """A function of Arrow batches that adds the text of their ``ids``."""

    def run(rows):
        import pyarrow as pa

        p = loaded(model)
        for whole in rows:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [p.decode(x.values.to_numpy()).decode("utf-8", "replace") if x.is_valid else None for x in batch.column("ids")]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return run


IDS = StructField("ids", ArrayType(IntegerType()))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` (with text) and ``ids`` array<int>."""
    docs = docs.drop("ids")
    return docs.mapInArrow(common.frugal("pieces", encoded_batches(model)), StructType([*docs.schema.fields, IDS]))


def decode(encoded: DataFrame, model: str, into: str = "decoded") -> DataFrame:
    """``encoded`` (with ids) and the text of the ids; null ids give null."""
    encoded = encoded.drop(into)
    return encoded.mapInArrow(common.frugal("pieces", decoded_batches(model, into)), StructType([*encoded.schema.fields, StructField(into, StringType())]))


def encode_and_decode(docs: DataFrame, model: str, into: str = "decoded") -> DataFrame:
    """``docs``, ``ids`` and the text of the ids: both ways in one Python worker."""
    docs = docs.drop("ids", into)
    there, back = encoded_batches(model), decoded_batches(model, into)
    return docs.mapInArrow(common.frugal("pieces", lambda rows: back(there(rows))), StructType([*docs.schema.fields, IDS, StructField(into, StringType())]))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids, decoded_sha256 and same (the decoded text equals the text with space marks as spaces)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    back = encode_and_decode(rows, model)
    plain = F.replace(F.col("text"), F.lit(MARK), F.lit(" "))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), (F.col("decoded") == plain).alias("same"))
