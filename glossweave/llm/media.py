"""Media columns: payloads as PNG members of archives, and a Spark data source that reads them.

Writing. A payload's bytes are the samples of an 8-bit grey image of `WIDTH` columns. A task packs its images into zip
archives (members stored, as they are compressed themselves) of bounded size in a shared folder, under names of its own
attempt. The rows it returns name its archives; they are kept as the table `_archives`, and an archive that
is not in it, left by a lost attempt, is never read.

Reading. The source lists the archives and their sizes and plans byte ranges; nothing else is read on the
driver. A task reads the archive's own directory, takes the members that begin in its range, and streams them as Arrow
batches of bounded bytes. A member is fetched by its offset and checked against the directory's CRC; if that fails, this
member alone is fetched again from a new handle. What still fails is an error, or a row with the error
and no media (option onError = "row").

Rows. Null text is empty: a payload of 576 bytes 255. A null doc_id and repeated rows come back as they are.
A very long text is a taller image and, if need be, an archive of its own. Empty tables write no archive and read no rows.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import time
import uuid
import zipfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from glossweave.llm.common import open_shared, read_table, shared_dir, small_batches, text_or_empty

WIDTH = 576
PAD = b"\xff"
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
TRIES = 4
SIGNATURE = b"\x89PNG\r\n\x1a\n"
NAME = re.compile(r"(null|-?[0-9]+)\.[0-9]+\.png")


def payload_of(text: bytes) -> bytes:
    return text + PAD * (-len(text) % WIDTH or (0 if text else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, level: int = 1) -> bytes:
    samples = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    rows = np.zeros((len(samples), WIDTH + 1), np.uint8)
    rows[:, 1:] = samples
    head = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    """The samples of an 8-bit grey image without row filters."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, packed, size = 8, [], None
    while at < len(media):
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        data = media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + data) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a chunk of the PNG is damaged")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + n
    if size is None or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey PNG")
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(size[1], size[0] + 1)
    if rows[:, 0].any():
        raise ValueError("rows are filtered")
    return rows[:, 1:].tobytes()


def _writer(folder: str, most: int):
    def run(batches):
        attempt, shard, count, members = uuid.uuid4().hex, 0, 0, 0
        target = archive = path = None

        def finish():
            archive.close()
            size = target.tell()
            target.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([members], pa.int64()), pa.array([size], pa.int64())], names=["path", "members", "bytes"])

        for batch in small_batches(batches, most=BATCH_BYTES):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if archive is None:
                    path, members = f"{folder}/media-{attempt}-{shard:06d}.zip", 0
                    target = open_shared(path, write=True)
                    archive = zipfile.ZipFile(target, "w", zipfile.ZIP_STORED)
                name = f"{'null' if doc is None else doc}.{count}.png"
                archive.writestr(zipfile.ZipInfo(name), to_png(payload_of(text.as_py().encode())))
                count, members = count + 1, members + 1
                if target.tell() >= most:
                    yield finish()
                    archive, shard = None, shard + 1
        if archive is not None:
            yield finish()

    return run


def write_archives(docs: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Packs docs (doc_id, text) into archives below folder and notes them in its table _archives."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts.mapInArrow(_writer(folder, archive_bytes), "path string, members long, bytes long").write.parquet(f"{folder}/_archives")


class MemberRange(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


def fetch_member(open_file, path: str, info: zipfile.ZipInfo, tries: int = TRIES, wait: float = 0.1) -> bytes:
    """The bytes of one member by its offset, checked; each try uses a handle of its own."""
    for left in reversed(range(tries)):
        try:
            with open_file(path) as f:
                f.seek(info.header_offset)
                head = f.read(30)
                if head[:4] != b"PK\x03\x04":
                    raise ValueError("no member begins here")
                f.seek(info.header_offset + 30 + sum(struct.unpack("<HH", head[26:30])))
                data = f.read(info.compress_size)
            if len(data) != info.file_size or zlib.crc32(data) != info.CRC:
                raise ValueError("the member is cut short or damaged")
            return data
        except (OSError, ValueError, struct.error) as e:
            if not left:
                raise OSError(f"{path} at {info.header_offset}: {e}") from e
            time.sleep(wait)
    raise ValueError("tries must be 1 at least")


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.range = int(options.get("rangeBytes", RANGE_BYTES))
        self.tries = int(options.get("tries", TRIES))
        self.keep_errors = options.get("onError", "fail") == "row"

    def partitions(self):
        """Byte ranges over the archives that were noted; a row of that table for each archive is all that is read."""
        import pyarrow.dataset as ds
        from pyarrow import fs

        place = f"{self.folder}/_archives"
        system, place = fs.FileSystem.from_uri(place) if "://" in place or place.startswith("file:") else (fs.LocalFileSystem(), place)
        noted = ds.dataset(place, filesystem=system, format="parquet").to_table()
        archives = zip(noted["path"].to_pylist(), noted["bytes"].to_pylist(), strict=True) if noted.num_rows else ()
        out = [MemberRange(path, at, min(size, at + self.range)) for path, size in archives for at in range(0, size, self.range)]
        return out or [MemberRange("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        with open_shared(partition.path) as f, zipfile.ZipFile(io.BufferedReader(f, 1 << 16)) as archive:
            members = [m for m in archive.infolist() if partition.start <= m.header_offset < partition.stop]
        rows, held = [], 0
        for m in members:
            data, error = None, None
            try:
                data = fetch_member(open_shared, partition.path, m, self.tries)
            except OSError as e:
                if not self.keep_errors:
                    raise
                error = str(e)
            doc = NAME.fullmatch(m.filename)
            rows.append((None if not doc or doc[1] == "null" else int(doc[1]), partition.path, m.filename, m.header_offset, data, error))
            held += len(data or b"")
            if held >= BATCH_BYTES:
                yield self.batch(rows)
                rows, held = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows) -> pa.RecordBatch:
        kinds = (("doc_id", pa.int64()), ("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary()), ("error", pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])


class ArchiveSource(DataSource):
    """spark.read.format("media_archive").load(folder): the members of all archives in a folder."""

    @classmethod
    def name(cls):
        return "media_archive"

    def schema(self):
        return "doc_id bigint, archive string, member string, offset bigint, media binary, error string"

    def reader(self, schema):
        return ArchiveReader(self.options)


def read_archives(spark, folder: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("media_archive").options(**options).load(folder)


def feature(payload: bytes) -> str:
    """Rows, mean sample, and a difference hash: 8 x 9 block means, each compared with its right neighbour."""
    samples = np.frombuffer(payload, np.uint8)
    edges = np.arange(73) * len(samples) // 72
    sums = np.concatenate([[0], np.cumsum(samples, dtype=np.int64)])
    means = ((sums[edges[1:]] - sums[edges[:-1]]) * 256 // np.maximum(1, np.diff(edges))).reshape(8, 9)
    bits = (means[:, 1:] > means[:, :-1]).ravel()
    return f"rows={len(samples) // WIDTH};mean={int(sums[-1]) // len(samples)};dhash={int(''.join('01'[int(b)] for b in bits), 2):016x}"


def measure(members: DataFrame) -> DataFrame:
    """doc_id, and what the stored bytes say of each member."""

    def run(batches):
        for batch in batches:
            media = batch.column("media").to_pylist()
            payloads = [from_png(m) for m in media]
            values = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(p.rstrip(PAD)) for p in payloads], pa.int64()),
                "payload_bytes": pa.array([len(p) for p in payloads], pa.int64()),
                "payload_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                "tail_crc32": pa.array([zlib.crc32(p[-32:]) for p in payloads], pa.int64()),
                "media_bytes": pa.array([len(m) for m in media], pa.int64()),
                "media_sha256": pa.array([hashlib.sha256(m).hexdigest() for m in media]),
                "feature": pa.array([feature(p) for p in payloads]),
            }
            yield pa.RecordBatch.from_arrays([*values.values()], names=[*values])

    return members.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op1_media(spark, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "media")
    write_archives(read_table(spark, sf_dir, "documents"), folder)
    return measure(read_archives(spark, folder).select("doc_id", "media"))
