"""The examples of relations as posting segments.

A relation's examples, in order of row_pos and seq, are cut into segments of up to SEGMENT, each one row: positions as differences, bytes of low places first, and the corpus ids, both compressed. first and last
are a segment's skip entries: who looks for a range of positions reads only the segments that meet it, and Spark's reader passes over row groups by them. Segments of later rows are
appended, none is written again. They are made by ranges of (relation, position), so a relation in a third of all rows is many segments in many tasks, never one row or one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.plans.storage import stored

SEGMENT = 4096
#: Bytes of a segment's ids, at about which it ends before it is full.
SEGMENT_BYTES = 256 << 10
#: Segments, their bytes, and rows of examples that go on together.
SEGMENTS_AT_ONCE = 1024
BYTES_AT_ONCE = 4 << 20
ROWS_AT_ONCE = 1 << 16
SEGMENTS = "pos string, relation_id bigint, first bigint, last bigint, n int, places binary, ids binary"


def _pack(values: np.ndarray, squeeze) -> bytes:
    return squeeze(np.ascontiguousarray(values.astype("<i8")).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(raw: bytes, expand) -> np.ndarray:
    return np.frombuffer(expand(raw), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def _segment(pos: str | None, relation: int, rows: list[tuple], squeeze) -> tuple:
    at, seq = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
    ids = [(r[2] or "").encode() for r in rows]
    sizes = np.array([-1 if r[2] is None else len(x) for r, x in zip(rows, ids, strict=True)], np.int64)
    places = _pack(np.concatenate([np.diff(at, prepend=0), seq, sizes]), squeeze)
    return pos, relation, int(at[0]), int(at[-1]), len(rows), places, squeeze(b"".join(ids))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    schema = pa.schema([("pos", pa.string()), ("relation_id", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int32()), ("places", pa.binary()), ("ids", pa.binary())])
    together = lambda some: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), schema.types, strict=True)], schema=schema)
    # most relations have a segment of a few examples, so many go on together, and one compressor makes all of a task's
    squeeze, made, weight = zstandard.ZstdCompressor(level=3).compress, [], 0
    key, rows, size = None, [], 0
    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("pos", "relation_id", "row_pos", "seq", "id"))
        for pos, relation, *row in zip(*columns, strict=True):
            if rows and (key != (pos, relation) or len(rows) >= SEGMENT or size >= SEGMENT_BYTES):
                made.append(_segment(*key, rows, squeeze))
                weight += len(made[-1][-1]) + len(made[-1][-2])
                rows, size = [], 0
                if len(made) >= SEGMENTS_AT_ONCE or weight >= BYTES_AT_ONCE:
                    yield together(made)
                    made, weight = [], 0
            key = pos, relation
            rows.append(row)
            size += len(row[2] or "")
    if rows:
        made.append(_segment(*key, rows, squeeze))
    if made:
        yield together(made)


def segments(examples: DataFrame) -> DataFrame:
    """Posting segments of example rows: pos, relation_id, row_pos, seq, id."""
    examples = examples if hasattr(examples, "stored_at") else stored(examples, "to-segment")
    order = ["pos", "relation_id", "row_pos", "seq"]
    return examples.repartitionByRange(*order).sortWithinPartitions(*order).select("pos", "relation_id", "row_pos", "seq", "id").mapInArrow(_cut, SEGMENTS)


def _example_batch(found: list[tuple]) -> pa.RecordBatch:
    """The example rows of some segments: pos, relation_id, positions, seq and ids of each."""
    pos, relation, at, seq, ids = zip(*found, strict=True)
    of = pa.array(np.repeat(np.arange(len(at)), [len(x) for x in at]))
    columns = [pa.array(pos, pa.string()).take(of), pa.array(relation, pa.int64()).take(of), pa.array(np.concatenate(at)), pa.array(np.concatenate(seq).astype(np.int32)), pa.array([x for some in ids for x in some], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["pos", "relation_id", "row_pos", "seq", "id"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress

    for batch in batches:
        found, n = [], 0
        for r in batch.to_pylist():
            places = _unpack(r["places"], expand)
            sizes = places[2 * r["n"] :]
            raw, ends = expand(r["ids"]), np.cumsum(np.maximum(sizes, 0)).tolist()
            ids = [None if s < 0 else raw[e - s : e].decode() for s, e in zip(sizes.tolist(), ends, strict=True)]
            found.append((r["pos"], r["relation_id"], np.cumsum(places[: r["n"]]), places[r["n"] : 2 * r["n"]], ids))
            n += r["n"]
            if n >= ROWS_AT_ONCE:
                yield _example_batch(found)
                found, n = [], 0
        if found:
            yield _example_batch(found)


def example_rows_of(found: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """The example rows of segments, with positions from start and below stop where these are given; other segments are passed over."""
    if start is not None:
        found = found.where(F.col("last") >= start)
    if stop is not None:
        found = found.where(F.col("first") < stop)
    rows = found.mapInArrow(_rows, "pos string, relation_id bigint, row_pos bigint, seq int, id string")
    if start is not None:
        rows = rows.where(F.col("row_pos") >= start)
    return rows if stop is None else rows.where(F.col("row_pos") < stop)
