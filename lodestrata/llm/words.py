"""Vectorised word and shingle hashing over UTF-8 bytes.

A word is ``[^\\x20\\x09-\\x0D]+``. Words are hashed from prefix sums of a
polynomial modulo 2**64, so a whole batch of documents costs a few numpy passes
and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE, _MULT = 0x9E3779B97F4A7C15, U(0xD1342543DE82EF95)
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 18  # small enough that every pass over a segment stays in the cache
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64's constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers below n; those of one segment (2 x 2 MB) are kept, longer ones are not."""
    if n <= _SEGMENT + 1 and _powers:
        return _powers[0]
    tables = []
    for base in (_BASE, _INVERSE):
        t = np.full(max(n, _SEGMENT + 1), base, U)
        t[0] = 1
        tables.append(np.multiply.accumulate(t))
    if n <= _SEGMENT + 1:
        _powers.append((tables[0], tables[1]))
    return tables[0], tables[1]


def _segment_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one buffer."""
    space = ((buf - np.uint8(9)) <= 4) | (buf == 32)
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _power_tables(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum(buf.astype(U) * power[: len(buf)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, ends, mix(h ^ (ends - starts).astype(U) * _MULT)


def hash_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets): document i owns ``hashes[offsets[i]:offsets[i + 1]]``."""
    joined = b"\n".join(texts)
    if lower:
        joined = joined.translate(_LOWER)
    buf = np.frombuffer(joined, np.uint8)
    at, starts, hashes = 0, [], []
    while at < len(buf):
        end = len(buf)
        if end - at > _SEGMENT:  # cut at white space, so no word is split
            size = _SEGMENT
            while True:
                piece = buf[at : at + size]
                gaps = np.flatnonzero(((piece - np.uint8(9)) <= 4) | (piece == 32))
                if len(gaps) or at + size >= len(buf):
                    break
                size *= 2
            end = at + int(gaps[-1]) + 1 if len(gaps) else len(buf)
        s, _, h = _segment_words(buf[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    return (np.concatenate(hashes) if hashes else np.zeros(0, U)), np.searchsorted(s, bounds)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; shorter sequences count whole, empty ones give none."""
    n = len(words)
    if n == 0:
        return words
    k = min(width, n)
    out = words[: n - k + 1].copy()
    for j in range(1, k):
        out = out * _MULT + words[j : n - k + 1 + j]
    return mix(out + U(k))


def byte_chunks(sizes: list[int], budget: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of consecutive items of about ``budget`` bytes; a larger item is alone."""
    i, total = 0, 0
    for j, size in enumerate(sizes):
        if j > i and total + size > budget:
            yield i, j
            i, total = j, 0
        total += size
    if i < len(sizes):
        yield i, len(sizes)


def text_chunks(texts: pa.Array, budget: int = 1 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """(i, j, texts i to j as bytes, nulls empty) of a column, by about ``budget`` bytes at a time."""
    raw = texts.cast(pa.binary())
    for i, j in byte_chunks(pc.fill_null(pc.binary_length(raw), 0).to_pylist(), budget):
        yield i, j, [t or b"" for t in raw.slice(i, j - i).to_pylist()]
