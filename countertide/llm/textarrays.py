"""Words of many texts as flat arrays: positions and 64-bit hashes, found without a loop over texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and where each begins (one more entry than texts)."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), offsets - (offsets[0] if len(offsets) else 0)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of texts: ``text`` (index of the text), ``start`` and ``end`` (byte places), ``hash``."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        data, self.offsets = flat_bytes(texts)
        inside = ~SEPARATOR[data]
        n = len(data)
        borders = np.unique(self.offsets[(self.offsets > 0) & (self.offsets < n)])
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[borders] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[borders - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(self.offsets, self.start, "right") - 1
        codes = LOWER[data] if lower else data
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
        place = _powers(_BASE_INVERSE, n)
        self.hash = mixed((sums[self.end] - sums[self.start]) * place[self.start] + (self.end - self.start).astype(np.uint64) * _STEP)
        #: First word of each text, and one entry more.
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``k`` words and its text; a text with fewer words gives its whole sequence once."""
        n = len(self.hash)
        if n >= k:
            out = self.hash[: n - k + 1].copy()
            for j in range(1, k):
                out = mixed(out * _M1 + self.hash[j : n - k + 1 + j])
            whole = self.text[: n - k + 1] == self.text[k - 1 :]
            out, owner = out[whole], self.text[: n - k + 1][whole]
        else:
            out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        counts = np.diff(self.first)
        for m in range(1, k):
            short = np.flatnonzero(counts == m)
            if len(short):
                h = self.hash[self.first[short]] ^ np.uint64(m)
                for j in range(1, m):
                    h = mixed(h * _M1 + self.hash[self.first[short] + j])
                out, owner = np.concatenate([out, mixed(h)]), np.concatenate([owner, short])
        if k > 1:
            order = np.argsort(owner, kind="stable")
            out, owner = out[order], owner[order]
        return out, owner
