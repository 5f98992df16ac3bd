"""Which of very many 64-bit keys occur more than once anywhere.

Keys come in blocks. A block sends each distinct key once, in one packed row for each bucket of keys; a bucket's rows meet in
one group of bounded size, as the number of buckets follows the input, and go back as one bit for each key. So a key that is
everywhere crosses once for each block, and what comes back is an eighth of a byte for each key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text for each bucket.
BUCKET_BYTES = 16 << 20
SENT = "bucket int, block long, keys binary, twice binary"
BACK = "block long, bucket int, shared binary"


def buckets_for(texts: DataFrame) -> int:
    """How many buckets the keys of these texts (column text) are dealt to."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 + size // BUCKET_BYTES


def arrange(keys: np.ndarray, deal: np.ndarray, buckets: int):
    """The distinct keys by bucket: (place of each key among them, edges of the buckets, the distinct keys, whether a key is there twice)."""
    bucket = (deal % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    k, b = keys[order], bucket[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (b[1:] != b[:-1])] if len(k) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    place = np.empty(len(keys), np.int64)
    place[order] = number
    counts = np.bincount(number, minlength=int(new.sum()))
    return place, np.searchsorted(b[new], np.arange(buckets + 1)), k[new], counts > 1


def send(block: int, arranged, packer) -> pa.RecordBatch:
    _, edges, keys, twice = arranged
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if b > a]
    packed = [packer.compress(np.diff(keys[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()) for _, a, b in rows]
    flags = [packer.compress(np.packbits(twice[a:b]).tobytes()) for _, a, b in rows]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array(packed, pa.binary()), pa.array(flags, pa.binary())], names=["bucket", "block", "keys", "twice"])


def _judge(table: pa.Table) -> pa.Table:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    parts = [np.cumsum(np.frombuffer(unpack(x), np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64) for x in table.column("keys").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(unpack(x), np.uint8))[: len(p)].astype(bool) for x, p in zip(table.column("twice").to_pylist(), parts, strict=True)]
    keys, twice = np.concatenate(parts), np.concatenate(flags)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    shared = np.empty(len(keys), bool)
    # of equal keys one at least may be alone in its block and twice in another
    run = np.cumsum(np.r_[True, ~same]) - 1
    many = np.bincount(run) > 1
    many |= np.bincount(run, weights=twice[order]) > 0
    shared[order] = many[run]
    edges = np.cumsum([0, *map(len, parts)])
    bits = [np.packbits(shared[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.Table.from_arrays([table.column("block"), table.column("bucket"), pa.array(bits, pa.binary())], names=["block", "bucket", "shared"])


def judge(sent: DataFrame) -> DataFrame:
    """For each row sent, the bits of its keys: set if the key is more than once in all blocks together."""
    return sent.groupBy("bucket").applyInArrow(_judge, BACK)


def flags(arranged, back: pa.Table) -> np.ndarray:
    """Whether each key of a block is shared, from the rows that came back to it."""
    place, edges, keys, _ = arranged
    out, seen = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    for bucket, bits in zip(back.column("bucket").to_pylist(), back.column("shared").to_pylist(), strict=True):
        a, b = edges[bucket], edges[bucket + 1]
        out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8))[: b - a].astype(bool)
        seen[a:b] = True
    if not seen.all():
        raise ValueError("a block's keys did not come back: its two scans differ")
    return out[place]
