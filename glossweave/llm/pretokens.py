"""Pre-tokens of many texts at once, by array operations on UTF-8 bytes.

Only for plain texts: tab, line ends, printable ASCII, and the letters U+00C0 to U+017F. On these the classes of the public
patterns are known byte by byte. Callers give other texts to a regular expression.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LETTER, DIGIT, OTHER, SPACE, BLANK = range(5)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    kind, plain = np.full(256, OTHER, np.uint8), np.zeros(256, bool)
    plain[[9, 10, 13, *range(32, 127), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = True
    kind[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = LETTER
    kind[48:58] = DIGIT
    kind[[9, 10, 13]] = BLANK
    kind[32] = SPACE
    return kind, plain


KIND, PLAIN = _classes()


def plain_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts are plain."""
    odd = ~PLAIN[data]
    # the multiplication and division signs lie among the letters
    odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    sums = np.concatenate([[0], np.cumsum(odd)])
    return sums[offsets[1:]] == sums[offsets[:-1]]


def byte_bpe_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in plain texts that lie end to end, by the rules of the public byte-level pattern.

    Runs of letters, digits or other marks take one space before them along. Of white space before a run, the last
    character stands alone unless it is such a space; white space at the end is one. 's 't 're 've 'm 'll 'd
    are cut off where the apostrophe begins a pre-token.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    kind = KIND[data]
    white = kind >= SPACE
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.r_[np.uint8(255), kind[:-1]]
    run = edge[:-1] | np.where(white, before < SPACE, kind != before)  # white space of both kinds is one run
    begins = run.copy()
    joined = np.zeros(len(data), bool)
    joined[1:] = ~white[1:] & (kind[:-1] == SPACE) & ~edge[1:-1]
    begins[joined] = False
    # the last white space before a run begins a pre-token
    last = np.zeros(len(data), bool)
    last[:-1] = white[:-1] & ~white[1:] & ~edge[1:-1]
    begins |= last
    # contractions
    at = np.flatnonzero((data == 39) & begins & ~edge[1:])
    at = at[~edge[at + 1]]
    if len(at):
        one = np.concatenate([data, np.zeros(3, np.uint8)])
        a, b = one[at + 1], one[at + 2]
        two_ok = ~edge[np.minimum(at + 2, len(data))]
        length = np.where(np.isin(a, (115, 116, 109, 100)), 1, np.where(two_ok & (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)), 2, 0))
        at, length = at[length > 0], length[length > 0]
        begins[at + 1] = False
        after = at + 1 + length
        inside = after < len(data)
        after = after[inside]
        begins[after[(kind[after] == LETTER) & ~edge[after]]] = True
    return np.flatnonzero(begins)


def word_bpe_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in plain lower-case texts: letters, single digits, other marks, contractions.

    The words cover every byte that is not white space.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    change = np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)] | edge[:-1]
    at = np.flatnonzero((data == 39) & change & ~edge[1:])
    if len(at):
        one = np.concatenate([data, np.zeros(3, np.uint8)])
        a, b = one[at + 1], one[at + 2]
        two_ok = ~edge[np.minimum(at + 2, len(data))]
        length = np.where(np.isin(a, (115, 116, 109, 100)), 1, np.where(two_ok & (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)), 2, 0))
        at, length = at[length > 0], length[length > 0]
        change[at + 1] = False
        after = at + 1 + length
        after = after[after < len(data)]
        change[after] = True
    starts = np.flatnonzero(change)
    ends = np.r_[starts[1:], len(data)]
    kept = kind[starts] < SPACE
    return starts[kept], ends[kept]


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """(the distinct spans as binary values, in order of first sight; the place of each span among them).

    inside: which bytes lie in a span, if there are others.
    """
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    data = data if inside is None else data[inside]
    spans = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = spans.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()
