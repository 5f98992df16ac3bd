"""A wavelet matrix in one compressed file: token access, counting and occurrence lookup.

Layout, all little-endian: 8 bytes of magic; 8 bytes, the length of the header; the header, JSON; then the parts that
it names. A sequence of n symbols of b bits has b planes. Plane k holds bit b-1-k of every symbol, in the order that k stable
partitions by the earlier bits have left: zeros first. Planes are cut into pieces of `PIECE` bits, each compressed
by itself, and an index has every piece's place and the ones before it; so a rank reads one piece.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import zstandard

MAGIC = b"GLOSSWM1"
PIECE = 1 << 16


def write_matrix(out, symbols: np.ndarray, bits: int, doc_ids: list, lengths: np.ndarray) -> int:
    """Writes symbols and the documents they belong to; returns the bytes written."""
    pack = zstandard.ZstdCompressor(level=1).compress
    pieces, index, zeros, at = [], [], [], 0
    order = symbols
    for k in range(bits):
        plane = ((order >> np.array(bits - 1 - k, order.dtype)) & np.array(1, order.dtype)).astype(bool)
        packed, ones = np.packbits(plane, bitorder="little"), 0
        places = []
        for i in range(0, len(plane), PIECE):
            piece = pack(packed[i // 8 : (i + PIECE) // 8].tobytes())
            places.append((at, len(piece), ones))
            ones += int(np.count_nonzero(plane[i : i + PIECE]))
            at += len(piece)
            pieces.append(piece)
        index.append(places)
        zeros.append(len(plane) - ones)
        order = np.concatenate([order[~plane], order[plane]])
    documents = pack(json.dumps([[None if d is None else int(d) for d in doc_ids], [int(x) for x in lengths]]).encode())
    table = pack(np.array([x for places in index for x in places], dtype="<u8").tobytes())
    header = json.dumps({"n": len(symbols), "bits": bits, "piece": PIECE, "zeros": zeros, "documents": len(documents), "index": len(table)}).encode()
    whole = [MAGIC, len(header).to_bytes(8, "little"), header, documents, table, *pieces]
    for part in whole:
        out.write(part)
    return sum(map(len, whole))


class WaveletMatrix:
    """Reads such a file; it fetches the header and the index, then only the pieces that it is asked for."""

    def __init__(self, source):
        self.source = source
        start = self._read(0, 16)
        if start[:8] != MAGIC:
            raise ValueError("not a wavelet matrix")
        size = int.from_bytes(start[8:], "little")
        head = json.loads(self._read(16, size))
        self.n, self.bits, self.piece, self.zeros = head["n"], head["bits"], head["piece"], head["zeros"]
        unpack = zstandard.ZstdDecompressor().decompress
        at = 16 + size
        self.doc_ids, self.lengths = json.loads(unpack(self._read(at, head["documents"])))
        at += head["documents"]
        table = np.frombuffer(unpack(self._read(at, head["index"])), "<u8").astype(np.int64)
        self.index = table.reshape(self.bits, -1, 3)
        self.data = at + head["index"]
        self.bit_piece = lru_cache(maxsize=256)(self._bit_piece)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _bit_piece(self, k: int, i: int) -> np.ndarray:
        at, size, _ = self.index[k, i]
        raw = zstandard.ZstdDecompressor().decompress(self._read(self.data + int(at), int(size)))
        return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: self.n - i * self.piece]

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        if i >= self.n:
            return self.n - self.zeros[k]
        piece, rest = divmod(i, self.piece)
        return int(self.index[k, piece, 2]) + int(np.count_nonzero(self.bit_piece(k, piece)[:rest]))

    def access(self, i: int) -> int:
        """Symbol i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        symbol = 0
        for k in range(self.bits):
            bit = int(self.bit_piece(k, i // self.piece)[i % self.piece])
            symbol = symbol << 1 | bit
            i = self.zeros[k] + self._ones(k, i) if bit else i - self._ones(k, i)
        return symbol

    def _range(self, symbol: int, i: int, j: int) -> tuple[int, int]:
        for k in range(self.bits):
            a, b = self._ones(k, i), self._ones(k, j)
            i, j = (self.zeros[k] + a, self.zeros[k] + b) if symbol >> (self.bits - 1 - k) & 1 else (i - a, j - b)
        return i, j

    def rank(self, symbol: int, i: int) -> int:
        """How often symbol is among the first i."""
        if symbol >> self.bits:
            return 0
        a, b = self._range(symbol, 0, min(i, self.n))
        return b - a

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """The position of occurrence k, from 0."""
        a, b = self._range(symbol, 0, self.n) if not symbol >> self.bits else (0, 0)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in reversed(range(self.bits)):
            bit = symbol >> (self.bits - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def _select_bit(self, k: int, bit: int, count: int) -> int:
        ones = self.index[k, :, 2]
        before = ones if bit else np.arange(len(ones)) * self.piece - ones
        piece = int(np.searchsorted(before, count, "right")) - 1
        return piece * self.piece + int(np.flatnonzero(self.bit_piece(k, piece) == bit)[count - int(before[piece])])

    def tokens(self) -> np.ndarray:
        """All symbols, by undoing the partitions from the last plane to the first."""
        out = np.zeros(self.n, np.uint32)
        unpack = zstandard.ZstdDecompressor().decompress
        for k in reversed(range(self.bits)):
            if not self.n:
                break
            first, (at, size, _) = self.index[k, 0], self.index[k, -1]
            raw, base = self._read(self.data + int(first[0]), int(at + size - first[0])), int(first[0])
            packed = b"".join(unpack(raw[int(a) - base : int(a + s) - base]) for a, s, _ in self.index[k])
            plane = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little")[: self.n].astype(bool)
            before = np.empty_like(out)
            before[~plane], before[plane] = out[: self.zeros[k]], out[self.zeros[k] :]
            out = before | plane.astype(np.uint32) << np.uint32(self.bits - 1 - k)
        return out
