r"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Pre-tokens are exploded with their positions, each distinct pre-token is encoded once, and its ids are joined
back by position. Documents are taken in blocks of bounded bytes: a block lists its distinct pre-tokens by falling count, so
a word leaves a block once however often it stands there, and a document is the sequence of its words' places in that
list. One scan writes both. The sequences stay where they are written, in a file of the shared folder for each task; the words,
dealt to buckets by hash, are a table. All blocks' rows of a bucket meet in one group of bounded size, as the number of buckets
follows the input; there each distinct word is encoded once, and its ids go back to the blocks that sent it.
A group for each block then reads the block's sequences and puts the ids at their positions.

A frequent word crosses the shuffle once for each block that has it, never once for each occurrence. A block sends a row for each
bucket, or for each word if it has fewer. Decoding looks every id up in the table of the token's bytes.

Lost executors. The table of words names the files of sequences, which bear the name of the attempt that wrote them, and the
files of a lost attempt are never read. What follows starts from that table, so it never depends on two scans that agree.

Rows. Null text is empty and has no ids. Columns in `keep` come back as they are, nulls, repeats and names included; one with the
name of an output column gives way to it.
A very long text is a block of its own. Empty tables give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from glossweave.llm.common import gathered, materialise, open_shared, packed_batch, read_table, release, releasing, shared_dir, short_batches, text_or_empty, unpacked_batch, values_bytes
from glossweave.llm.pretokens import byte_bpe_starts, distinct_spans, plain_texts
from glossweave.llm.words import HASH_BYTES, span_hashes

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text in a block: the larger, the fewer words leave several blocks.
BLOCK = 12 << 20
#: Bytes of text for each bucket of words.
BUCKET_BYTES = 32 << 20
#: Documents whose sequences are packed together.
DOCS_AT_ONCE = 256
#: Rows decoded at a time.
DECODED_AT_ONCE = 256
SENT = "block long, bucket int, places binary, words binary, path string, first int, parts int"
BACK = "block long, places binary, lengths binary, tokens binary, path string, first int, parts int"


def rank_file(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    """The token-byte table: a bounded number of rows, the vocabulary."""
    with open(path, "rb") as f:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=1)
def token_table(path: str) -> np.ndarray:
    """The bytes of each id, by the id."""
    known = token_bytes(path)
    return np.array([known.get(i) for i in range(max(known) + 1)], dtype=object)


@lru_cache(maxsize=2)
def whole_word_encoder(path: str):
    """Encodes its whole input as one pre-token."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks={b: i for i, b in token_bytes(path).items()}, special_tokens={})


@lru_cache(maxsize=1)
def splitter():
    r"""The public pattern; \s spelt as the Unicode property, as the encoding library reads it."""
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = plain_texts(data, offsets)
    if plain.all():
        return byte_bpe_starts(data, offsets)
    find, raw, parts = splitter().findall, data.tobytes(), [np.zeros(0, np.int64)]
    edges = np.flatnonzero(np.r_[True, plain[1:] != plain[:-1], True])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if plain[a]:
            parts.append(byte_bpe_starts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) + offsets[a])
            continue
        for i in range(a, b):
            sizes = [len(w.encode()) for w in find(raw[offsets[i] : offsets[i + 1]].decode())]
            parts.append(np.cumsum([0, *sizes[:-1]]) + offsets[i] if sizes else np.zeros(0, np.int64))
    return np.concatenate(parts)


def starts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in texts that lie end to end, a few megabytes at a time; they cover every byte."""
    parts, i = [np.zeros(0, np.int32)], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + HASH_BYTES, "right")) - 1)
        parts.append((_starts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) + offsets[i]).astype(np.int32))
        i = j
    return np.concatenate(parts)


def block_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words by falling count, their places in order, the first of each text)."""
    data, offsets = values_bytes(column)
    starts = starts_of(data, offsets)
    firsts = np.searchsorted(starts, offsets)
    words, kind = distinct_spans(data, starts, np.append(starts[1:], np.int32(len(data))) if len(starts) else starts)
    order = np.argsort(-np.bincount(kind, minlength=len(words)), kind="stable")
    place = np.empty(len(words), np.int32)
    place[order] = np.arange(len(words), dtype=np.int32)
    return words.take(pa.array(order)), place[kind], firsts


def _planes(values: np.ndarray, pack) -> bytes:
    """Unsigned numbers as byte planes, low bytes first, compressed."""
    return pack(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unplanes(packed: bytes, unpack) -> np.ndarray:
    return np.frombuffer(unpack(packed), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _packed_words(words: pa.Array, pack) -> bytes:
    """Lengths as byte planes, then the bytes."""
    data, offsets = values_bytes(words)
    sizes = np.diff(offsets).astype("<u4")
    return pack(len(sizes).to_bytes(4, "little") + sizes.view(np.uint8).reshape(-1, 4).T.tobytes() + data.tobytes())


def _unpacked_words(packed: bytes, unpack) -> pa.Array:
    raw = unpack(packed)
    n = int.from_bytes(raw[:4], "little")
    sizes = np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, -1).T.copy().view("<u4").ravel()
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[4 + 4 * n :])])


SEQUENCE = pa.schema([("rows", pa.binary()), ("counts", pa.binary()), ("sequence", pa.binary())])


def _blocks(folder: str, buckets: int):
    """Writes the sequences of each block to the task's file; a row for each block names them, others hold its words."""

    def rows(columns) -> pa.RecordBatch:
        kinds = dict(block=pa.int64(), bucket=pa.int32(), places=pa.binary(), words=pa.binary(), path=pa.string(), first=pa.int32(), parts=pa.int32())
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns.get(k, [None] * n), t) for k, t in kinds.items()], names=list(kinds))

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=1).compress
        path, part = f"{folder}/sequences-{uuid.uuid4().hex}.arrow", TaskContext.get().partitionId()
        sink = writer = None
        number = written = 0
        for batch in gathered(batches, "text", BLOCK):
            if writer is None:
                sink = open_shared(path, write=True)
                writer = pa.ipc.new_file(sink, SEQUENCE)
            block = (part << 32) + number
            words, places, firsts = block_words(batch.column("text"))
            kept = batch.select([n for n in batch.schema.names if n != "text"])
            del batch
            first = written
            for i in range(0, kept.num_rows, DOCS_AT_ONCE):
                some = kept.slice(i, DOCS_AT_ONCE)
                edges = firsts[i : i + some.num_rows + 1]
                values = packed_batch(some), _planes(np.diff(edges), pack), _planes(places[edges[0] : edges[-1]], pack)
                writer.write_batch(pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], schema=SEQUENCE))
                written += 1
            del places, kept
            yield rows({"block": [block], "path": [path], "first": [first], "parts": [written - first]})
            data, offsets = values_bytes(words)
            bucket = (span_hashes(data, offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
            out: dict = {"block": [], "bucket": [], "places": [], "words": []}
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                at = order[a:b]
                out["block"].append(block)
                out["bucket"].append(int(bucket[at[0]]))
                out["places"].append(_planes(np.diff(at, prepend=0), pack))
                out["words"].append(_packed_words(words.take(pa.array(at)), pack))
            if out["block"]:
                yield rows(out)
            number += 1
            del words, data, offsets, out
            release()
        if writer is not None:
            writer.close()
            sink.close()

    return releasing(run)


def encoded_words(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each word, all ids end to end)."""
    encode = whole_word_encoder(path).encode_ordinary
    ids = [encode(w) for w in words.cast(pa.string()).to_pylist()]
    return np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter((x for i in ids for x in i), np.int32)


def _encode_bucket(path: str):
    """Each distinct word of a bucket is encoded once; a row goes back for each that came."""

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        pack, unpack = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        parts = [_unpacked_words(x.as_buffer(), unpack) for x in table.column("words").combine_chunks()]
        sizes = np.array([len(p) for p in parts])
        coded = pa.concat_arrays(parts).dictionary_encode()
        del parts
        length, ids = encoded_words(path, coded.dictionary)
        start, kinds = np.cumsum(length) - length, coded.indices.to_numpy()
        lengths, tokens, at = [], [], 0
        for n in sizes.tolist():
            kind = kinds[at : at + n]
            many = length[kind]
            upto = np.cumsum(many)
            lengths.append(_planes(many, pack))
            tokens.append(_planes(ids[np.repeat(start[kind] - (upto - many), many) + np.arange(upto[-1])], pack))
            at += n
        columns = [table.column("block"), table.column("places"), pa.array(lengths, pa.binary()), pa.array(tokens, pa.binary()), table.column("path"), table.column("first"), table.column("parts")]
        release()
        return pa.Table.from_arrays(columns, names=["block", "places", "lengths", "tokens", "path", "first", "parts"])

    return run


def _assemble(schema: pa.Schema):
    import zstandard

    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        read = lambda name: [_unplanes(x.as_buffer(), unpack) for x in table.column(name).combine_chunks() if x.is_valid]
        place = np.concatenate([np.cumsum(x) for x in read("places")] or [np.zeros(0, np.int64)])
        length = np.concatenate(read("lengths") or [place])
        ids = np.concatenate([x.astype(np.int32) for x in read("tokens")] or [np.zeros(0, np.int32)])
        start_of, length_of = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        start_of[place], length_of[place] = np.cumsum(length) - length, length
        head = next(r for r in table.select(["path", "first", "parts"]).to_pylist() if r["path"] is not None)
        batches = []
        with open_shared(head["path"]) as source:
            file = pa.ipc.open_file(source)
            for i in range(head["first"], head["first"] + head["parts"]):
                packed, counts, sequence = (c[0].as_py() for c in file.get_batch(i).columns)
                seq, counts = _unplanes(sequence, unpack), _unplanes(counts, unpack)
                n = length_of[seq]
                upto = np.concatenate([[0], np.cumsum(n)])
                flat = ids[np.repeat(start_of[seq] - upto[:-1], n) + np.arange(upto[-1])]
                ends = upto[np.concatenate([[0], np.cumsum(counts)])]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                kept = unpacked_batch(packed)
                batches.append(pa.RecordBatch.from_arrays([*kept.columns, lists], schema=schema))
        release()
        return pa.Table.from_batches(batches, schema=schema)

    return run


def encode(docs: DataFrame, keep=("doc_id",), path: str | None = None, ids: str = "ids") -> DataFrame:
    """The columns `keep` of docs and, as the column named by ids, the token ids of its text, array<int>."""
    path, spark = path or rank_file(), docs.sparkSession
    keep = [c for c in keep if c.lower() != ids.lower()]
    short_batches(spark)
    # the kept columns cross by other names, so that one of them may be called text
    names = [f"kept_{i}" for i in range(len(keep))]
    texts = docs.select(text_or_empty().alias("text"), *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)])
    buckets = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES
    sent = materialise(texts.mapInArrow(_blocks(shared_dir(spark, "bpe-sequences"), buckets), SENT), "bpe-words")
    back = sent.where("bucket IS NOT NULL").groupBy("bucket").applyInArrow(_encode_bucket(path), BACK)
    heads = sent.where("bucket IS NULL").select("block", *[F.lit(None).cast("binary").alias(n) for n in ("places", "lengths", "tokens")], "path", "first", "parts")
    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return back.unionByName(heads).groupBy("block").applyInArrow(_assemble(to_arrow_schema(schema)), schema)


def joined_bytes(lists: pa.Array, table: np.ndarray, between: bytes = b""):
    """The values of table at the ids of each list, joined; None for a null."""
    for x in lists:
        yield between.join(table[x.values.to_numpy()].tolist()) if x.is_valid else None


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encoded and, as the column named by decoded, the bytes of its tokens; an id outside the table is an error, null ids give null."""
    path = path or rank_file()
    encoded = encoded.drop(decoded)

    def run(batches):
        table = token_table(path)
        for batch in batches:
            for i in range(0, batch.num_rows, DECODED_AT_ONCE):
                part = batch.slice(i, DECODED_AT_ONCE)
                texts = list(joined_bytes(part.column(part.schema.get_field_index(ids)), table))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, decoded])

    return encoded.mapInArrow(releasing(run), T.StructType([*encoded.schema.fields, T.StructField(decoded, T.BinaryType())]))


def digests(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded documents (doc_id, ids)."""
    path = path or rank_file()

    def run(batches):
        table = token_table(path)
        numbers = np.array([str(i).encode() for i in range(len(table))], dtype=object)
        sha = lambda raw: None if raw is None else hashlib.sha256(raw).hexdigest()
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            columns = [batch.column(batch.schema.get_field_index("doc_id")), pa.array([len(x) if x.is_valid else None for x in ids], pa.int64())]
            columns += [pa.array([sha(x) for x in joined_bytes(ids, *how)], pa.string()) for how in ((numbers, b","), (table,))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(releasing(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(encode(read_table(spark, sf_dir, "documents")))
