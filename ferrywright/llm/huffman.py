"""Canonical length-limited Huffman coding of token ids, on numpy arrays.

Small helpers for the tasks of :mod:`ferrywright.llm.tokens`: code lengths by
package-merge, packing of whole arrays, and decoding of many blocks in step.
"""

from __future__ import annotations

import numpy as np

MAX_BITS = 20


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for a count of 0.

    A single used symbol gets one bit, none get none.
    """
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts > 0)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    is_leaf = []
    packages = np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        is_leaf.append(rank < n)
        merged = both[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * n - 2
    for flags in reversed(is_leaf):
        chosen = int(flags[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), the usual canonical rule."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    code, before = 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        code = (code + before) << 1
        own = np.flatnonzero(lengths == bits)
        codes[own] = code + np.arange(len(own), dtype=np.uint32)
        before = len(own)
    return codes


class Encoder:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths).astype(np.uint64)

    def encode(self, ids: np.ndarray, block: int) -> tuple[bytes, np.ndarray]:
        """The packed bits, and the bit offset at which each block of ``block`` ids begins."""
        if not len(ids):
            return b"", np.zeros(0, dtype=np.int64)
        size = self.lengths[ids]
        ends = np.cumsum(size)
        at = ends - size
        word = at >> 5
        shift = (64 - size - (at & 31)).astype(np.uint64)
        value = self.codes[ids] << shift
        words = int(ends[-1] + 31 >> 5) + 1
        # Codes never overlap, so sums of 32-bit halves are exact in float64.
        out = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=words + 1)
        out[1:] += np.bincount(word, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=words)[:words]
        packed = out[:words].astype(np.uint64).astype(">u4").tobytes()
        return packed[: int(ends[-1] + 7 >> 3)], at[::block].copy()


class Decoder:
    """Table-driven: one look-up of the next ``bits`` bits gives symbol and length."""

    def __init__(self, lengths: np.ndarray):
        self.bits = max(1, int(lengths.max(initial=1)))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = 1 << (self.bits - lengths[order].astype(np.int64))
        table = np.repeat(order.astype(np.uint32) << 5 | lengths[order], spans)
        self.table = np.zeros(1 << self.bits, dtype=np.uint32)
        self.table[: len(table)] = table

    def decode(self, packed: bytes, offsets: np.ndarray, n_ids: int, block: int) -> np.ndarray:
        """All blocks are decoded in step, one id of each at a time; a block needs its own offset only."""
        data = np.frombuffer(packed + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        windows = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
        at = offsets.astype(np.int64).copy()
        last = n_ids - block * (len(offsets) - 1)
        drop = np.uint32(32 - self.bits)
        live = len(offsets)
        ids = np.zeros((block, len(offsets)), dtype=np.uint32)
        for step in range(min(block, n_ids)):
            if step == last and live == len(offsets):
                live -= 1
                at = at[:live]
            if not live:
                break
            hit = self.table[windows[at >> 3] << (at & 7).astype(np.uint32) >> drop]
            ids[step, :live] = hit >> 5
            at += hit & 31
        return ids.T.reshape(-1)[:n_ids]
