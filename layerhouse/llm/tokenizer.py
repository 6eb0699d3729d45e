"""Byte-level BPE with the tokenizers library, over Arrow columns.

The library splits a text at white space before it merges bytes, so the ids of a text are the ids
of its pieces (a run of spaces and line feeds with what follows up to the next run), one after
the other; a stop behind a plain letter starts a piece of its own. Each distinct piece is encoded once per worker
and found again by a 64-bit polynomial hash with random byte values; its bytes are kept and compared
each time, and a text with a piece whose hash belongs to another one goes through the library whole. So do texts
with other white space, and tokenizers of another kind.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from layerhouse.llm.common import slices, string_bytes

CHUNK_BYTES = 1 << 20
STOPS = ".,!?;:"
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LOADED: dict[tuple[str, int], Encoder] = {}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str, most_pieces: int = 1_000_000) -> Encoder:
    """The worker's own encoder, kept between tasks."""
    key = (path, most_pieces)
    if key not in _LOADED:
        _LOADED[key] = Encoder(path, most_pieces)
    return _LOADED[key]


def _splits_at_spaces(tokenizer) -> bool:
    plan = json.loads(tokenizer.to_str())
    pre = plan["pre_tokenizer"] or {}
    return (
        plan["normalizer"] is None and plan["truncation"] is None and plan["padding"] is None
        and plan["model"]["type"] == "BPE" and not plan["model"]["dropout"]
        and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in plan["added_tokens"])
        and not any(c.isspace() or c in STOPS for t in plan["added_tokens"] for c in t["content"])
    )


def _picked(flat: np.ndarray, first: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` one after the other, and where each begins now."""
    begin = np.cumsum(held) - held
    return flat[np.repeat(first - begin, held) + np.arange(held.sum())], begin


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    return np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


class Encoder:
    """``most_pieces`` bounds the cache (some 100 bytes each, and 64 bytes of text for each in the mean); a full
    one keeps what is in use just now.

    New pieces are looked up in a small index of their own, which is merged into the large one now and then.
    """

    def __init__(self, path: str, most_pieces: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_piece = _splits_at_spaces(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.most_pieces = most_pieces
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.byte_sign = {b: 256 + i for i, b in enumerate(hidden)}  # signs of the bytes that have none of their own
        draw = np.random.default_rng(20240)
        self.byte_value = draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x9E3779B97F4A7C15 | 3
        inverse = pow(base, -1, 2**64)
        self.powers, self.inverses = (self._powers(b, CHUNK_BYTES + 1) for b in (base, inverse))
        self.is_gap, self.is_stop, self.is_letter = (np.zeros(256, bool) for _ in range(3))
        self.is_gap[[32, 10]] = True
        self.is_stop[[ord(c) for c in STOPS]] = True
        self.is_letter[[*range(65, 91), *range(97, 123)]] = True
        self._forget()

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def _forget(self) -> None:
        self.known = self.fresh = pd.Index(np.zeros(0, np.uint64))
        self.flat = np.zeros(0, np.uint32)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.text = np.zeros(0, np.uint8)
        self.words = _words(self.text)
        self.at = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def _piece(self, piece: str) -> list[int] | None:
        """Ids of a piece; None if it holds white space other than leading spaces and line feeds."""
        body = piece[1:]
        if piece[0] == " " and body.isalpha():
            word = body if body.isascii() else body.encode().decode("latin-1").translate(self.byte_sign)
            return [t.id for t in self.model.tokenize("Ġ" + word)]
        body = piece.lstrip(" \n")
        if body and body.split() != [body]:
            return None
        if any(a in body for a in self.added):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)
        return [t.id for word, _ in words for t in self.model.tokenize(word)]

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids = [self._piece(p.decode()) for p in pieces]
        count = np.array([-1 if x is None else len(x) for x in ids], np.int64)
        flat = np.fromiter(chain.from_iterable(x for x in ids if x), np.uint32)
        held = np.maximum(count, 0)
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(held) - held])
        self.flat = np.concatenate([self.flat, flat])
        self.count = np.concatenate([self.count, count])
        length = np.array([len(p) for p in pieces], np.int64)
        self.at = np.concatenate([self.at, len(self.text) + np.cumsum(length) - length])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(pieces), np.uint8)])
        self.words = _words(self.text)
        self.length = np.concatenate([self.length, length])
        self.fresh = pd.Index(np.concatenate([self.fresh.to_numpy(), hashes]))
        if len(self.fresh) > 50_000 + len(self.known) // 4:
            self.known = pd.Index(np.concatenate([self.known.to_numpy(), self.fresh.to_numpy()]))
            self.fresh = pd.Index(np.zeros(0, np.uint64))

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Cache entry of each hash, -1 for those that are not there."""
        found = self.known.get_indexer(hashes)
        other = np.flatnonzero(found < 0)
        if len(other) and len(self.fresh):
            late = self.fresh.get_indexer(hashes[other])
            found[other] = np.where(late < 0, -1, late + len(self.known))
        return found

    def _entries(self, hashes: np.ndarray, piece_of) -> np.ndarray:
        """Cache entry of each hash; ``piece_of(i)`` is the i-th piece."""
        found = self._find(hashes)
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found
        if len(self.count) + len(new) > self.most_pieces or len(self.text) > 64 * self.most_pieces:
            kept = found[found >= 0]
            self.flat, self.first = _picked(self.flat, self.first[kept], np.maximum(self.count[kept], 0))
            self.text, self.at = _picked(self.text, self.at[kept], self.length[kept])
            self.count, self.length = self.count[kept], self.length[kept]
            self.known, self.fresh = pd.Index(hashes[found >= 0]), pd.Index(np.zeros(0, np.uint64))
        self._learn(hashes[new], [piece_of(i) for i in new.tolist()])
        return self._find(hashes)

    def _same(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Whether the pieces, which cover ``data``, are those of their cache entries."""
        length, at = stops - starts, self.at[entry]
        same = self.length[entry] == length
        words, done, rest = _words(data), 0, np.flatnonzero(same)
        while len(rest) and done < 64:
            differ = (words[starts[rest] + done] ^ self.words[at[rest] + done]) & LOW_BYTES[np.minimum(length[rest] - done, 8)] != 0
            same[rest[differ]] = False
            done += 8
            rest = rest[~differ & (length[rest] > done)]
        for i in rest.tolist():
            same[i] = np.array_equal(data[starts[i] + done:stops[i]], self.text[at[i] + done:at[i] + length[i]])
        return same

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(x) for x in found], np.int64)

    def _chunk(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not self.by_piece or n > CHUNK_BYTES:  # one very long text, or another kind of tokenizer
            raw = data.tobytes()
            return self._whole([raw[s:e].decode() for s, e in zip(ends[:-1], ends[1:])])
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(ends) - 1, np.int64)
        gap = self.is_gap[data]
        starts = gap.copy()
        starts[1:] &= ~gap[:-1]
        starts[1:] |= self.is_stop[data[1:]] & self.is_letter[data[:-1]]
        starts[ends[:-1][ends[:-1] < n]] = True
        starts = np.flatnonzero(starts)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte_value[data] * self.powers[:n], out=sums[1:])
        stops = np.append(starts[1:], n)
        codes, hashes = pd.factorize((sums[stops] - sums[starts]) * self.inverses[starts])
        sample = np.zeros(len(hashes), np.int64)
        sample[codes] = np.arange(len(codes))
        raw = data.tobytes()
        a, b = starts[sample].tolist(), stops[sample].tolist()
        entry = self._entries(hashes, lambda i: raw[a[i]:b[i]])[codes]
        count = self.count[entry]
        odd = (count < 0) | ~self._same(data, starts, stops, entry)
        count = np.maximum(count, 0)
        before = np.concatenate([[0], np.cumsum(count)])
        shift = np.repeat(self.first[entry] - before[:-1], count)
        ids = self.flat[shift + np.arange(len(shift))]
        cut = before[np.searchsorted(starts, ends)]
        if not odd.any():
            return ids, np.diff(cut)
        texts = np.searchsorted(ends, starts[odd], side="right") - 1
        parts, sizes = [], np.diff(cut)
        odd_texts = set(texts.tolist())
        for i in range(len(sizes)):
            part = ids[cut[i]:cut[i + 1]]
            if i in odd_texts:
                part = self._whole([raw[ends[i]:ends[i + 1]].decode()])[0]
                sizes[i] = len(part)
            parts.append(part)
        return np.concatenate(parts), sizes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        data, ends = string_bytes(column)
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a, b in slices(np.diff(ends), CHUNK_BYTES):
            part = self._chunk(data[ends[a]:ends[b]], ends[a:b + 1] - ends[a])
            ids.append(part[0])
            sizes.append(part[1])
        return np.concatenate(ids), np.concatenate(sizes)
