"""Words of many texts at once, as 64-bit hashes, by array operations on their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

#: An odd multiplier and its inverse modulo 2**64: a word's hash is a polynomial in it, then mixed.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text to hash at once: arrays of 8 bytes for each stay small.
HASH_BYTES = 1 << 20
KEPT_POWERS = 1 << 20
#: Spans of more bytes are hashed one by one.
LONG_SPAN = 256
#: For each length up to 8, the bits of a 64-bit word that so many bytes fill.
FILLED = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1); one table for each base is kept, up to KEPT_POWERS entries."""
    table = _POWERS.get(base)
    if table is None or len(table) < n:
        table = np.full(max(1 << 16, 1 << (int(n) - 1).bit_length()), base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        if len(table) <= KEPT_POWERS:
            _POWERS[base] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words in texts that lie end to end, and the first word of each text."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The 64-bit word that begins at each byte, with zeros after the end; no copy for each."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte span; equal bytes have equal hashes wherever they lie. Spans are read 8 bytes at a time."""
    import xxhash

    size = ends - starts
    out = mix(size.astype(np.uint64) * np.uint64(BASE))
    words, live, at = eight_bytes(data), np.flatnonzero((size > 0) & (size <= LONG_SPAN)), 0
    while len(live):
        part = words[starts[live] + at] & FILLED[np.minimum(size[live] - at, 8)]
        out[live] = mix(out[live] ^ part) * np.uint64(BASE)
        at += 8
        live = live[size[live] > at]
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def hashed_words(data: np.ndarray, offsets: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first word of each text); fold: A-Z count as a-z."""
    data = lower_ascii(data) if fold else data
    starts, ends, firsts = word_spans(data, offsets)
    return span_hashes(data, starts, ends), starts, ends, firsts
