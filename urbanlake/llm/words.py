"""Vectorised words, word hashes and windows over a batch of texts (used inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 21:
            _POWERS[base] = have
    return have[:n]


def canonical(text: str | None, lower: bool = False) -> bytes:
    """Words ``[^\\x20\\x09-\\x0D]+`` joined by one space, as UTF-8; ``lower`` folds A-Z only."""
    if not text:
        return b""
    raw = text.encode("utf-8", "surrogatepass")
    return b" ".join((raw.lower() if lower else raw).split())


class Words:
    """Words of several texts: byte range in ``data``, text number and 64-bit hash of each."""

    def __init__(self, texts: Sequence[bytes]):
        self.data = b" ".join(texts) + b" "
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        buf = np.frombuffer(self.data, dtype=np.uint8)
        space = buf == 32
        self.end = np.flatnonzero(space & ~np.concatenate(([True], space[:-1])))
        self.start = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
        first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
        self.doc = np.searchsorted(first, self.start, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        if len(self.start):
            sums = np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(buf)))
            before = np.where(self.start > 0, sums[self.start - 1], np.uint64(0))
            self.hash = mix((sums[self.end - 1] - before) * _powers(_INVERSE, len(buf))[self.start] + (self.end - self.start).astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def windows(self, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word number and hash of every window of ``k`` words within one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, sequence_hash([self.hash[at + j] for j in range(k)], seed)


def sequence_hash(parts: Sequence[np.ndarray], seed: int = 0) -> np.ndarray:
    """Hash of a sequence of word hashes, position by position."""
    h = np.full(len(parts[0]), np.uint64(seed) + np.uint64(len(parts)), dtype=np.uint64)
    for part in parts:
        h = mix(h * _BASE + part)
    return h


def slices(texts: Sequence[bytes], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` bytes each (a longer text is alone)."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield begin, i
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield begin, len(texts)
