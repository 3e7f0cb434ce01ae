"""Rolling hashes and content-defined anchors over sequences of units (words or bytes).

A window is W consecutive units. Its anchor is the gram of K units with the least hash in it, the
leftmost at a tie: a function of the window's content alone, so equal windows have equal anchors at
equal places. The windows of a document that share one anchor follow each other; such a stretch is
an occurrence. Its class is the 128-bit BLAKE2b digest of the very words or bytes that its windows cover.
Occurrences of one class hold the same windows; a window can be equal to another only below the
same anchor hash. Comparing anchors and classes first leaves few windows to compare one by one.

The rolling hash is only for finding candidates: equal units always have equal hashes, and different
ones with equal hashes (which chosen input can bring about) make more to compare, never a hit.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_INDEX = U((1 << 28) - 1)
#: Longest piece of a document hashed at once, in units.
PIECE = 1 << 22

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _need(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size + 1, base, U)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A random 64-bit value for each byte.
BYTE_UNIT = mix(np.arange(1, 257, dtype=U) * U(_BASE))


def prefix(units: np.ndarray) -> np.ndarray:
    """Prefix sums of unit times power: span() has the hash of any stretch from two of them."""
    power, _ = _need(len(units))
    out = np.zeros(len(units) + 1, U)
    np.cumsum(units * power[: len(units)], out=out[1:])
    return out


def span(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[first]) * _need(len(sums))[1][first]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    m = 1
    while 2 * m <= width:
        x = np.minimum(x[:-m], x[m:])
        m *= 2
    return np.minimum(x[: len(x) - (width - m)], x[width - m :]) if m < width else x


def word_bounds(data: np.ndarray, off: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of each word, and the row offsets in words. separator: a truth value for each byte."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separator[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    first = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return first, end, np.searchsorted(first, off)


def stretches(first: np.ndarray, end: np.ndarray, limit: int = 1 << 20):
    """Ranges of words that hold about limit bytes together."""
    a = 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(end, first[a] + limit, "right")))
        yield a, b
        a = b


def word_units(data: np.ndarray, first: np.ndarray, end: np.ndarray, table: np.ndarray = BYTE_UNIT) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.zeros(len(first), U)
    for a, b in stretches(first, end):
        base = first[a]
        sums = prefix(table[data[base : end[b - 1]]])
        out[a:b] = mix(span(sums, first[a:b] - base, end[a:b] - base) + (end[a:b] - first[a:b]).astype(U) * U(0xD6E8FEB86659FD93))
    return out


#: Space and the bytes 9 to 13 part words.
WHITESPACE = np.zeros(256, bool)
WHITESPACE[[32, 9, 10, 11, 12, 13]] = True


def pieces(off: np.ndarray, window: int):
    """(row, first, end) in units: long rows in pieces that overlap by window - 1 units."""
    for row in range(len(off) - 1):
        a, b = int(off[row]), int(off[row + 1])
        while b - a > PIECE:
            yield row, a, a + PIECE
            a += PIECE - window + 1
        yield row, a, b


def digests(data, first: list[int], end: list[int]) -> np.ndarray:
    """BLAKE2b digests of 128 bits of data[first:end], as two columns of 64-bit numbers."""
    data, new = memoryview(data), hashlib.blake2b
    return np.frombuffer(b"".join([new(data[a:b], digest_size=16).digest() for a, b in zip(first, end, strict=True)]), np.int64).reshape(-1, 2)


def joined(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words data[first:end] with one blank after each, and where each begins in that (and the end of all)."""
    start = np.append(0, np.cumsum(end - first + 1))
    out = np.full(start[-1], 32, np.uint8)
    for a, b in stretches(first, end):
        size = end[a:b] - first[a:b]
        word = np.repeat(np.arange(a, b), size)
        step = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
        out[start[word] + step] = data[first[word] + step]
    return out, start


def occurrences(units: np.ndarray, off: np.ndarray, window: int, gram: int):
    """Anchor occurrences of each row: row, first window's start in its row, number of windows, anchor hash, anchor's start in its row."""
    if len(off) > 1 and int(np.diff(off).max(initial=0)) > PIECE:
        parts = []
        for row, a, b in pieces(off, window):
            r, lo, n, g, p = occurrences(units[a:b], np.array([0, b - a]), window, gram)
            at = a - int(off[row])
            parts.append((r + row, lo + at, n, g, p + at))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    n = len(units)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    sums = prefix(units)
    _, inverse = _need(n)
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    least = sliding_min((grams & ~_INDEX) | np.arange(len(grams), dtype=U), window - gram + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[: n - window + 1]
    start = np.flatnonzero(np.arange(n - window + 1) + window <= off[1:][row])
    anchor = (least[start] & _INDEX).astype(np.int64)
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = anchor[1:] != anchor[:-1]
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, len(anchor)))
    lo, anchor = start[at], anchor[at]
    begin = off[row[lo]]
    return row[lo], lo - begin, count, grams[anchor], anchor - begin


def covered(n: int, lo, count, window: int) -> np.ndarray:
    """Which of n units are covered by the windows that start in [lo, lo + count)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.asarray(lo, np.int64), 1)
    np.add.at(edge, np.minimum(np.asarray(lo, np.int64) + np.asarray(count, np.int64) - 1 + window, n), -1)
    return np.cumsum(edge[:-1]) > 0
