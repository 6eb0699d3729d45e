"""Canonical length-limited Huffman codes over token ids, encoded and decoded with numpy.

Ids are coded in blocks. A block notes the bit at which every ``STEP``-th id starts, so the stretches between
can be decoded side by side: one table lookup gives the next id of every stretch.
"""

from __future__ import annotations

import numpy as np

STEP = 128
LONGEST = 24


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Code length of every id, 0 for those that do not occur, by package-merge.

    ``limit`` is the longest code allowed, by default two bits more than codes of one length would need.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    need = int(n - 1).bit_length()
    limit = min(LONGEST, need + 2) if limit is None else limit
    if not need <= limit <= LONGEST:
        raise ValueError(f"codes of at most {limit} bits cannot tell {n} ids apart")
    order = np.argsort(counts[used], kind="stable")
    weights = counts[used][order].astype(np.int64)
    packages = np.zeros(0, np.int64)
    leaf_rows = []
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        at = np.argsort(merged, kind="stable")
        leaf_rows.append(at < n)
        merged = merged[at]
        packages = merged[0:len(merged) // 2 * 2:2] + merged[1::2]
    found, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(leaf_rows):
        leaves = int(leaf[:take].sum())
        found[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[used[order]] = found
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes: in the order of length and id, each the successor of the one before."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code = previous = 0
    for i in order.tolist():
        code <<= int(lengths[i]) - previous
        codes[i], previous = code, int(lengths[i])
        code += 1
    return codes


class Code:
    """The tables of one code, made from the lengths alone."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical(lengths)
        self.bits = max(1, int(lengths.max(initial=0)))
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.used = np.zeros(1 << self.bits, np.uint8)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        width = 1 << (self.bits - self.lengths[order])
        filled = int(width.sum())
        self.symbol[:filled] = np.repeat(order, width)
        self.used[:filled] = np.repeat(self.lengths[order], width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(bits padded to 32-bit words, checkpoints as 64-bit offsets)."""
        if not len(ids):
            return b"", b""
        n = self.lengths[ids]
        stop = np.cumsum(n)
        first = stop - n
        words = np.zeros(int(stop[-1] + 31) // 32 + 2, np.uint32)
        word, shift = first >> 5, first & 31
        value = self.codes[ids].astype(np.uint64) << (64 - shift - n).astype(np.uint64)
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        at = word[heads]
        words[at] |= np.bitwise_or.reduceat((value >> np.uint64(32)).astype(np.uint32), heads)
        words[at + 1] |= np.bitwise_or.reduceat((value & np.uint64(0xFFFFFFFF)).astype(np.uint32), heads)
        return words[:int(stop[-1] + 31) // 32].astype(">u4").tobytes(), first[::STEP].astype("<i8").tobytes()

    def decode(self, blocks: list[tuple[bytes, bytes, int]]) -> list[np.ndarray]:
        """Ids of each (bits, checkpoints, number of ids); all stretches of all blocks step together."""
        words = np.frombuffer(b"".join(b for b, _, _ in blocks) + bytes(8), ">u4").astype(np.uint64)
        starts, counts, base = [], [], 0
        for bits, marks, n in blocks:
            marks = np.frombuffer(marks, "<i8")
            starts.append(marks + base)
            left = np.full(len(marks), STEP)
            if len(marks):
                left[-1] = n - STEP * (len(marks) - 1)
            counts.append(left)
            base += len(bits) * 8
        at, left = np.concatenate(starts), np.concatenate(counts)
        out = np.zeros((STEP, len(at)), np.uint32)
        order = np.argsort(-left, kind="stable")  # the stretches that end early come last
        at, ends = at[order], left[order]
        mask, drop = np.uint64((1 << self.bits) - 1), 64 - self.bits
        for step in range(int(ends[0]) if len(ends) else 0):
            live = int(np.searchsorted(-ends, -step, side="left"))
            here = at[:live]
            word = here >> 5
            window = (words[word] << np.uint64(32)) | words[word + 1]
            key = (window >> (drop - (here & 31)).astype(np.uint64)) & mask
            out[step, order[:live]] = self.symbol[key]
            here += self.used[key]
        found, column = [], 0
        for _, marks, n in blocks:
            lanes = len(marks) // 8
            found.append(out[:, column:column + lanes].T.reshape(-1)[:n])
            column += lanes
        return found
