"""Vectorised hashing of words, byte ranges and word ranges over batches of texts.

A prefix sum of symbol * base**position (modulo 2**64) gives the hash of any
range of symbols in O(1). Symbols are mixed before and hashes after. There are
two bases, so that two hashes of a range are two different polynomials.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 5
OTHER_BASE = 0xC2B2AE3D27D4EB4F
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size, made = 1 << n.bit_length(), []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _powers[base] = (made[0], made[1])
    return _powers[base]


class Ranges:
    """Hashes of ranges of a symbol sequence."""

    def __init__(self, symbols: np.ndarray, base: int = BASE) -> None:
        up, self._down = powers(len(symbols) + 1, base)
        self._sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=self._sums[1:])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = (stop - start).astype(np.uint64)
        return mix((self._sums[stop] - self._sums[start]) * self._down[start] + mix(size + np.uint64(1)))


def chunks(texts: Sequence[bytes], most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own and whole."""
    begin = total = 0
    for i, t in enumerate(texts):
        if i > begin and total + len(t) > most:
            yield begin, i
            begin, total = i, 0
        total += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def joined(texts: Sequence[bytes], gap: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, parted by ``gap``, and the first byte of each (and of one more)."""
    sizes = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    return np.frombuffer(gap.join(texts), np.uint8), np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])


def words(texts: Sequence[bytes], lower: bool = False, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts, and the first word of each text (and of one more).

    A hash depends on its word alone, so long inputs are read in pieces that end at white space; a longer word is whole.
    """
    data, bounds = joined(texts, b" ")
    spaces = SPACE[data]
    hashes, begins = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(data):
        stop = len(data)
        if stop - at > most:
            ends = np.flatnonzero(spaces[at + most :])  # the last byte of data is a space
            stop = at + most + int(ends[0]) + 1
        inside = np.zeros(stop - at + 2, np.int8)
        inside[1:-1] = ~spaces[at:stop]
        edges = np.diff(inside)
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        part = data[at:stop]
        hashes.append(Ranges(BYTES[LOWER[part] if lower else part]).hash(begin, end))
        begins.append(begin + at)
        at = stop
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), bounds)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    blocks = np.full((-(-len(x) // width) + 1, width), np.iinfo(x.dtype).max, x.dtype)
    blocks.reshape(-1)[: len(x)] = x
    before = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], before[width - 1 : width - 1 + n])


def anchors(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int, most: int = 1 << 19) -> tuple[np.ndarray, ...]:
    """The minimiser of every window of ``window`` symbols within a text, as runs of windows that share it.

    Returns text, first window's start (within its text), number of windows, the minimiser's offset from that start,
    the hash of its gram, and the hash by the other base of the whole run's symbols with the offset. Equal windows have
    equal minimisers, wherever they stand. Ties go to the leftmost. Long inputs are read ``most`` windows at a time; a
    run that such a cut parts is two runs.
    """
    parts = []
    for at in range(0, max(1, len(symbols) - window + 1), most):
        parts.append(_anchors(symbols[at : at + most + window - 1], at, bounds, window, gram))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _anchors(symbols: np.ndarray, base: int, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    n = len(symbols) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    at = np.arange(len(symbols) - gram + 1)
    grams = Ranges(symbols).hash(at, at + gram)
    least = sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), window - gram + 1) & np.uint64(0xFFFFFFFF)
    place = least.astype(np.int64)
    text = np.searchsorted(bounds, np.arange(base, base + len(symbols)), "right") - 1
    whole = text[:n] == text[window - 1 : window - 1 + n]
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, n))
    first, count = first[whole[first]], count[whole[first]]
    place = place[first]
    context = mix(Ranges(symbols, OTHER_BASE).hash(first, first + count + window - 1) + (place - first).astype(np.uint64))
    return text[first], first + base - bounds[text[first]], count, place - first, grams[place].view(np.int64), context.view(np.int64)
