"""What the operators of this subpackage share: inputs, the shared folder, bounded Arrow batches."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of a document: a maximal run without ASCII white space (fixed value, as Java and RE2 read it).
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text in one block at most, unless one text alone is longer.
BLOCK_BYTES = 16 << 20
#: Bits of a bitmap for each key that it holds, and the most and fewest of all: 8 MB and 8 KB.
KEY_BITS, MOST_BITS, LEAST_BITS = 16, 1 << 26, 1 << 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where scratch() is in use, the folders made inside it.
_scratch: list[list[str]] = []


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Where that setting is absent, a local master gets a temporary folder; a cluster gets an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="glossweave-")
    path = f"{base.rstrip('/')}/glossweave/{label}-{uuid.uuid4().hex}"
    for made in _scratch[-1:]:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Removes the shared folders that were made inside, when it ends. What is to stay is written to a folder from before,
    and what is lazy and reads them must have been computed."""
    _scratch.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _scratch.pop():
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialise(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Cuts the lineage: writes df as a table in the shared folder (to path, if given) and reads it back."""
    spark = df.sparkSession
    path = path or shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bitmap(keys: DataFrame, name: str) -> bytes:
    """The buckets that the longs in column `name` fall in, as a bitmap sized by their number; what is in it is looked at, so it only saves work.

    Beyond MOST_BITS / KEY_BITS keys (4 million) it lets more and more others through. At most MOST_BITS / 64 rows come to the driver.
    """
    import numpy as np

    size = min(MOST_BITS, max(LEAST_BITS, 1 << (KEY_BITS * keys.count()).bit_length()))
    word = F.shiftright(F.col(name).bitwiseAND(size - 1), 6).cast("int").alias("word")
    bit = F.expr(f"shiftleft(1L, cast({name} & 63 AS int))")
    bits = np.zeros(size // 64, "<i8")
    found = keys.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bits.tobytes()


def in_bitmap(bits: bytes, keys):
    """Whether each key (64-bit integers) falls in one of the buckets."""
    import numpy as np

    packed = np.frombuffer(bits, np.uint8)
    at = keys.view(np.uint64) & np.uint64(8 * len(packed) - 1)
    return (packed[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of df is called so; Spark does not tell case apart."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices Arrow batches so that `column` holds at most `most` bytes in each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = value_offsets(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = start + 1
            while stop < batch.num_rows and offsets[stop + 1] - offsets[start] <= most:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Joins Arrow batches so that `column` holds about `most` bytes in each, and slices what is larger."""

    def joined(parts):
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held, size = [], 0
    for batch in small_batches(batches, column, most):
        offsets = value_offsets(batch.column(batch.schema.get_field_index(column)))
        if held and size + offsets[-1] - offsets[0] > most:
            yield joined(held)
            held, size = [], 0
        held.append(batch)
        size += offsets[-1] - offsets[0]
    if held:
        yield joined(held)


def short_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Lowers the session's rows in an Arrow batch, which the JVM and Python hold at the same time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(rows))


def release() -> None:
    """Gives freed memory back to the system: workers live on after a task, beside those of other steps."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call, it keeps what it holds
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run):
    """A function on Arrow batches that releases memory when a task is done."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def packed_batch(batch: pa.RecordBatch) -> bytes:
    """A batch as one compressed value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked_batch(raw: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(raw)))


def value_offsets(column: pa.Array):
    """Offsets of a string or binary column's values, as Python integers, one more than its rows."""
    import numpy as np

    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    whole = np.frombuffer(column.buffers()[1], dtype=kind)
    return whole[column.offset : column.offset + len(column) + 1].tolist()


def values_bytes(column: pa.Array):
    """All values of a string or binary column as one byte array, and their offsets in it."""
    import numpy as np

    offsets = np.array(value_offsets(column), dtype=np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def open_shared(path: str, write: bool = False):
    """A file of the shared folder, from driver or executor; path is a URI or a local path."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if not write:
        return system.open_input_file(place)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return system.open_output_stream(place)
