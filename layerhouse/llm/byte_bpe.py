"""Byte-level BPE by a file of ranks, with the tokenizers library over Arrow batches, and its inverse.

The library's model works on characters, so every byte is shown as one: printable Latin-1 characters stand for
themselves, the others for 256 and above. A rank file merges any two neighbours whose joined bytes have a rank,
lowest rank first; the library wants the merges as pairs, so each token gives one for every way to cut it in two
tokens. The pre-tokenizer cuts the text by a pattern, and a match that is a token itself is not merged at all.

Pieces, a run of ASCII white space and what follows up to the next run, have the same ids alone as inside a
text; each distinct one is encoded once per worker. The cut holds for patterns in which nothing but a leading space
joins white space with other characters. Texts with other white space go to the library whole.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_PIECES = 400_000
CACHED_CHARS = 64
BLOCK = 1 << 16
PIECE = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
#: The white space of Unicode outside ASCII, and the separators that count as such in some libraries.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_LOADED: dict[tuple[str, str], Codec] = {}


def byte_signs() -> dict[int, str]:
    """The character that stands for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def load(path: str, pattern: str) -> Codec:
    """The worker's own codec, kept between tasks."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


class Codec:
    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Regex, Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        sign = byte_signs()
        shown = {token: "".join(map(sign.__getitem__, token)) for token in ranks}
        merges = [
            (shown[token[:i]], shown[token[i:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        self.tokenizer = Tokenizer(BPE({shown[t]: rank for t, rank in ranks.items()}, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = Sequence(
            [Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
        back = {character: byte for byte, character in sign.items()}
        self.token = [b""] * (max(ranks.values()) + 1)
        for word, rank in self.tokenizer.get_vocab().items():
            self.token[rank] = bytes(map(back.__getitem__, word))
        self.length = np.array([len(t) for t in self.token], np.int64)
        self.known: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if OTHER_SPACE.search(text):
            return self._library([text])[0]
        out, pieces = [], PIECE.finditer(text)
        while block := [m.group() for m in islice(pieces, BLOCK)]:
            known = self.known
            if new := list({p for p in block if p not in known}):
                if len(known) + len(new) > CACHED_PIECES:
                    known = self.known = {p: known[p] for p in set(block) if p in known}
                known.update(zip(new, self._library(new)))
            out.append(b"".join(map(known.__getitem__, block)))
            for p in new:
                if len(p) > CACHED_CHARS:
                    del known[p]
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids; an id without a token is an error."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def starts(self, text: str, ids: bytes) -> np.ndarray:
        """For every id the place in ``text`` of the character that its first byte belongs to."""
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        length = self.length[np.frombuffer(ids, "<u4")]
        return character[np.cumsum(length) - length].astype("<u4")

    def texts(self, blocks: Iterable[bytes]) -> Iterator[str]:
        """The text of packed ids that come in blocks: a character cut by a block's end comes with the next one.

        Bytes that are no character become U+FFFD.
        """
        held = codecs.getincrementaldecoder("utf-8")("replace")
        for block in blocks:
            yield held.decode(self.decode(block))
        yield held.decode(b"", True)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", starts: bool = False) -> DataFrame:
    """Rows (doc_id, n_tokens, ids): the ids as binary, little-endian unsigned 32-bit; a null text has none.

    With ``starts`` also the place of each id's first character in the text, packed in the same way. ``path`` is
    a rank file that all executors have. One row for each row of ``docs``, repeated rows included; null doc_ids stay null.
    """

    def run(batches):
        codec = load(path, pattern)
        for batch in batches:
            columns = {"doc_id": batch.column(0)}
            texts = [value.as_py() or "" for value in batch.column(1)]
            found = [codec.encode(t) for t in texts]
            columns["n_tokens"] = pa.array([len(x) // 4 for x in found], pa.int64())
            columns["ids"] = pa.array(found, pa.binary())
            if starts:
                columns["starts"] = pa.array([codec.starts(t, x).tobytes() for t, x in zip(texts, found)], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary" + (", starts binary" if starts else ""))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds to rows (doc_id, n_tokens, ids) of :func:`encode` the bytes that the ids stand for, as ``decoded``."""

    def run(batches):
        codec = load(path, pattern)
        for batch in batches:
            decoded = [codec.decode(value.as_py() or b"") for value in batch.column(2)]
            yield pa.record_batch([*batch.columns, pa.array(decoded, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")
