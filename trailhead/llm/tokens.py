"""Exact encoding with a public word-level BPE tokenizer, quickened by a bounded memo of whole words.

The tokenizer drops white space and never joins characters across it, so the ids of a text are the ids of its
words one after the other.  Words are remembered as little-endian 32-bit id bytes; a text is then a ``bytes.join``.
"""

from __future__ import annotations

import os
import unicodedata

from trailhead.llm import common

MEMO_WORDS = 500_000
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: Characters that are still a letter or an ASCII digit at their end once they are lower-case and composed (U+0130 is not).
ENDS = frozenset(chr(c) for c in range(0x250) if chr(c) in "0123456789" or unicodedata.category(unicodedata.normalize("NFC", chr(c).lower())[-1])[0] == "L")


class Memo(dict):
    """Id bytes by word (lower-case UTF-8 bytes); a word that is missing is looked up in the former memo or learned."""

    def __init__(self, tokenizer, alphabet: dict[int, str], packed: list[bytes], former: dict):
        super().__init__()
        self.tokenizer, self.tokenize, self.alphabet, self.packed, self.former = tokenizer, tokenizer.model.tokenize, alphabet, packed, former

    def __missing__(self, word: bytes) -> bytes:
        ids = self.former.get(word)
        if ids is None:
            ids = self.learned(word)
        self[word] = ids
        return ids

    def learned(self, word: bytes) -> bytes:
        packed = self.packed
        if word.isalpha() and word.islower():  # ASCII letters, which the byte-level alphabet shows as themselves
            return b"".join([packed[t.id] for t in self.tokenize(word.decode())])
        text = word.decode("utf-8", "replace")
        if text.isalpha() and text.islower() and all(ord(c) in self.alphabet for c in text):
            # Latin letters alone are one unit to the tokenizer: its BPE model gets them at once, in the byte-level alphabet.
            return b"".join([packed[t.id] for t in self.tokenize(text.translate(self.alphabet))])
        stem = word.rstrip(PUNCTUATION)
        if stem and len(stem) < len(word) and b"<|" not in word and stem.decode("utf-8", "replace")[-1] in ENDS:
            # Units end between a letter or digit and the punctuation after it.
            return self[stem] + self[word[len(stem) :]]
        return b"".join([packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])


class WordEncoder:
    """Encodes texts (UTF-8 bytes) to the ids that ``tokenizers`` gives without special tokens, then ``end_id``.

    The memo holds at most ``memo_words`` words and those of one text; when full it starts anew and takes over what it
    still needs of its former self.  Text bytes are split at ASCII white space only; whatever else the tokenizer treats
    as white space stays inside a "word" that the library itself encodes.
    """

    def __init__(self, path: str, end_id: int | None = 1, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        self.memo_words = memo_words
        shown = [c for c in range(256) if 33 <= c < 127 or 161 <= c < 173 or 174 <= c]  # the byte-level alphabet shows these bytes as themselves
        letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.alphabet = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x250) if chr(c).isalpha() and chr(c) == chr(c).lower() and unicodedata.is_normalized("NFC", chr(c))}
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.memo = Memo(self.tokenizer, self.alphabet, self.packed, {})

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        out = []
        for t in texts:
            t = t or b""
            if len(self.memo) > self.memo_words:
                self.memo = Memo(self.tokenizer, self.alphabet, self.packed, dict(self.memo))
            # The tokenizer ignores case, but in the names of special tokens.
            out.append(b"".join(map(self.memo.__getitem__, (t if b"<|" in t else t.lower()).split())) + self.end)
        return out


def encoder(path: str, end_id: int | None = 1, memo_words: int = MEMO_WORDS) -> WordEncoder:
    """One encoder for each Python worker, settings and file."""
    key, held = (path, end_id, memo_words), common.kept("tokens")
    if key not in held:
        held[key] = WordEncoder(*key)
    return held[key]


def batches(texts, ids, most_docs: int = 256, most_bytes: int = 1 << 20):
    """Cut an Arrow batch into lists of (ids, texts as bytes) of bounded count and size."""
    import pyarrow as pa

    texts = texts.cast(pa.binary())
    out_i, out_t, size = [], [], 0
    for i, t in zip(ids.to_pylist(), texts, strict=True):
        t = t.as_py()
        out_i.append(i)
        out_t.append(t)
        size += len(t or b"")
        if len(out_i) >= most_docs or size >= most_bytes:
            yield out_i, out_t
            out_i, out_t, size = [], [], 0
    if out_i:
        yield out_i, out_t
