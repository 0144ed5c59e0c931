"""Canonical length-limited Huffman codes over integer ids, vectorised in numpy.

A block's bits are written most significant first. ``marks`` holds the bit at
which every ``STEP``-th id starts: a reader can begin at any of them, and the
table-driven decoder here begins at all of them at once.
"""

from __future__ import annotations

import numpy as np

MAX_BITS = 16
STEP = 64


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths (0: not used) of an optimal code of at most ``max_bits`` bits (or as
    many as so many symbols need), by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(used)
    max_bits = max(max_bits, (n - 1).bit_length())
    if n <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    level, leaves = weights, [np.ones(n, dtype=bool)]
    for _ in range(max_bits - 1):
        pairs = len(level) // 2
        merged = np.concatenate([weights, level[0:2 * pairs:2] + level[1:2 * pairs:2]])
        by_weight = np.argsort(merged, kind="stable")
        leaves.append(by_weight < n)
        level = merged[by_weight]
    take, total = 2 * n - 2, np.zeros(n, dtype=np.int64)
    for is_leaf in reversed(leaves):
        mine = int(is_leaf[:take].sum())
        total[:mine] += 1
        take = 2 * (take - mine)
    lengths[order] = total
    return lengths


class Code:
    """The canonical code of some lengths: shorter first, then by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, dtype=np.uint8)
        self.bits = max(1, int(self.lengths.max(initial=0)))
        ids = np.flatnonzero(self.lengths)
        ids = ids[np.lexsort((ids, self.lengths[ids]))]
        width = np.int64(1) << (self.bits - self.lengths[ids].astype(np.int64))
        first = np.concatenate([[0], np.cumsum(width)[:-1]]) if len(ids) else width
        self.codes = np.zeros(len(self.lengths), dtype=np.uint64)
        self.codes[ids] = first >> (self.bits - self.lengths[ids].astype(np.int64))
        size = 1 << self.bits
        self.table_id = np.zeros(size, dtype=np.uint32)
        self.table_length = np.ones(size, dtype=np.uint8)
        filled = int(width.sum())
        self.table_id[:filled] = np.repeat(ids, width)
        self.table_length[:filled] = np.repeat(self.lengths[ids], width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(bits, marks as little-endian uint32)."""
        size = self.lengths[ids].astype(np.int64)
        end = np.cumsum(size)
        start = end - size
        value = self.codes[ids] << (64 - (start & 31) - size).astype(np.uint64)
        word = start >> 5
        n = int(end[-1] // 32 + 2) if len(ids) else 0
        words = (np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n)
                 + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n))
        bits = words.astype(np.uint64).astype(">u4").tobytes()[:-(-int(end[-1]) // 8)] if len(ids) else b""
        return bits, start[::STEP].astype("<u4").tobytes()

    def decode(self, blocks: list[tuple[bytes, bytes, int]]) -> np.ndarray:
        """All ids of blocks (bits, marks, number of ids), one after another."""
        pad, base, at, lanes = b"\0" * 8, 0, [], []
        for bits, marks, n in blocks:
            own = np.frombuffer(marks, dtype="<u4").astype(np.int64)
            at.append(own + 8 * base)
            lanes.append(np.minimum(STEP, n - STEP * np.arange(len(own))))
            base += len(bits) + len(pad)
        if not at:
            return np.zeros(0, dtype=np.uint32)
        data = np.frombuffer(pad.join(b for b, _, _ in blocks) + pad, dtype=np.uint8).astype(np.uint32)
        windows, wide = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:], 24
        if self.bits > 17:  # a code and the 7 bits before it need a fourth byte
            windows, wide = (windows[:-1] << 8) | data[3:], 32
        at, lanes = np.concatenate(at), np.concatenate(lanes)
        last = 8 * len(windows) - 1
        out = np.empty((STEP, len(at)), dtype=np.uint32)
        drop = wide - self.bits
        for k in range(STEP):
            peek = (windows[at >> 3] >> (drop - (at & 7)).astype(np.uint32)) & np.uint32((1 << self.bits) - 1)
            out[k] = self.table_id[peek]
            at = np.minimum(at + self.table_length[peek], last)
        return out.T[np.arange(STEP) < lanes[:, None]]
