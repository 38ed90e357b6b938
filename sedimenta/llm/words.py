"""Words of whole texts, vectorised over Arrow buffers.

A word is ``[^\\x20\\x09-\\x0D]+``.  Python sees no single word: starts, ends and
64-bit hashes are computed with numpy for about ``SLICE_BYTES`` of text at a
time (one longer text is a slice of its own), so a task's memory does not
depend on the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64, at least ``n`` of them."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        out = np.full(max(n, 1024), base, dtype=np.uint64)
        out[0] = 1
        known = _powers[int(base)] = np.multiply.accumulate(out)
    return known


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of some consecutive texts.

    ``start`` and ``end`` are byte positions in ``data``; the words of text
    ``i`` are ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~IS_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._word = word

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash per word; ``lower`` folds A-Z."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        size = self.end - self.start
        end = np.cumsum(size)
        begin = end - size
        letters, table = self.data[self._word], _BYTE_LOWER if lower else _BYTE
        out = np.empty(len(size), dtype=np.uint64)
        at = 0
        while at < len(size):
            # A long text is one slice; its letters are weighed a slice at a time.
            upto = max(at + 1, int(np.searchsorted(end, begin[at] + SLICE_BYTES, side="right")))
            low, own = begin[at], slice(at, upto)
            place = np.arange(end[upto - 1] - low) - np.repeat(begin[own] - low, size[own])
            value = table[letters[low:end[upto - 1]]] * powers(_BASE, int(size[own].max()) + 1)[place]
            out[own] = np.add.reduceat(value, begin[own] - low)
            at = upto
        return mix(out + size.astype(np.uint64))

    def text_of(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values of ``h`` (texts not told apart)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    p = powers(_STEP, k + 1)
    if k <= 8:
        out = h[:n].copy()
        for j in range(1, k):
            out += h[j:j + n] * p[j]
        return mix(out)
    # Sums over a window from two prefix sums; the step is odd, so it can be divided out.
    inverse = np.uint64(pow(int(_STEP), -1, 2**64))
    up, down = powers(_STEP, len(h)), powers(inverse, len(h))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:len(h)], dtype=np.uint64)))
    return mix((total[k:] - total[:-k]) * down[:n])


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)


def unsigned(h: np.ndarray) -> np.ndarray:
    return h.view(np.uint64)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Cut a batch into slices of about ``limit`` bytes of text, with their words.

    A NULL text counts as empty.
    """
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        upto = min(max(upto, at + 1), len(texts))
        own = offsets[at:upto + 1]
        yield batch.slice(at, upto - at), Words(raw[own[0]:own[-1]], own - own[0])
        at = upto


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from concatenated values and the cumulative ends."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
