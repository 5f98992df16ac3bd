r"""Token ids as binary output: documents in ascending doc_id order, one wavelet matrix file for each shard.

Documents are dealt by ranges of doc_id and sorted; a task encodes its range, fills shards of `SHARD_TOKENS` ids
and writes each to the shared folder under a name of its own attempt. The shards that count are the rows that
the tasks return, kept as a table, so what a lost or repeated attempt has written is never read. The ids before
each shard are a running sum over that table, which has a row for a few million ids.

Ids are those of the tokenizers library. Its normaliser and splitter are applied here to texts made only of
characters on which they are known (ASCII, Latin letters); each distinct word of some megabytes is encoded by the library's model,
many words in a call, and the words of late are kept in a bounded table. Any other text goes to the library whole.

Rows. Null text is empty: only the end id. A null doc_id comes before all others. Equal doc_ids are ordered by
text. Repeated rows come back as often as they are there. A document longer than a shard makes a longer shard.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.common import materialise, open_shared, read_table, releasing, shared_dir, small_batches, text_or_empty
from glossweave.llm.pretokens import KIND, SPACE, distinct_spans, plain_texts, word_bpe_spans
from glossweave.llm.wavelet import WaveletMatrix, write_matrix

TOKENIZER = "word_bpe_49k.json"
END = 1
SHARD_TOKENS = 2 << 20
#: Words whose ids a worker keeps of late, twice at most.
KEPT_WORDS = 120_000
#: Words that the model takes in one text.
WORDS_IN_TEXT = 200
SOME_TEXT = 4 << 20
MANIFEST = "part int, shard int, path string, n_docs long, n_tokens long, n_bytes long"

def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}


class Words:
    """The ids of words: the library's model, with a table of the words of late."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        # the same model over words that are given as such, one to a line
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.ends_word = np.zeros(self.whole.get_vocab_size(), bool)
        self.ends_word[[i for token, i in self.whole.get_vocab(with_added_tokens=False).items() if token.endswith("</w>")]] = True
        self.shown = byte_characters() | {10: 10}
        self.late, self.before = {}, {}

    def _encode(self, words: list[bytes]) -> None:
        texts = [b"\n".join(words[i : i + WORDS_IN_TEXT]).decode("latin-1").translate(self.shown) for i in range(0, len(words), WORDS_IN_TEXT)]
        ids = np.concatenate([np.array(e.ids, self.kind) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            raise ValueError("words and their ids do not match: this vocabulary does not mark the ends of words")
        raw, size = ids.tobytes(), self.kind().itemsize
        for word, a, b in zip(words, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            self.late[word] = raw[a * size : b * size]

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes."""
        if len(self.late) > KEPT_WORDS:
            self.before, self.late = self.late, {}
        late, before, new = self.late, self.before, []
        for w in words:
            if w not in late:
                if w in before:
                    late[w] = before[w]
                else:
                    new.append(w)
        if new:
            self._encode(new)
        return [late[w] for w in words]


@lru_cache(maxsize=1)
def load(path: str) -> Words:
    return Words(path)


def encode_texts(path: str, texts: list[str]) -> list[np.ndarray]:
    """The ids of each text, without the end id."""
    import pyarrow.compute as pc

    words = load(path)
    kind = words.kind
    raw = [t.lower().encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    # texts with the start of a special token's name go to the library as well
    plain = plain_texts(np.frombuffer(b"".join(raw), np.uint8), offsets) & np.array([b"<|" not in r for r in raw], bool)
    out: list = [None] * len(texts)
    odd = np.flatnonzero(~plain).tolist()
    for i, e in zip(odd, words.whole.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False) if odd else (), strict=True):
        out[i] = np.array(e.ids, kind)
    at = np.flatnonzero(plain)
    data, offsets = np.frombuffer(b"".join(raw[i] for i in at), np.uint8), np.cumsum([0, *[len(raw[i]) for i in at]])
    starts, ends = word_bpe_spans(data, offsets)
    distinct, word_of = distinct_spans(data, starts, ends, KIND[data] < SPACE)
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct), b"\n")[0].as_py()
    found = words.ids(lines.split(b"\n")) if len(distinct) else []
    ids = np.frombuffer(b"".join(found), kind)
    size = np.fromiter(map(len, found), np.int64, len(found)) // kind().itemsize
    start_of, n = np.cumsum(size) - size, size[word_of]
    upto = np.concatenate([[0], np.cumsum(n)])
    flat = ids[np.repeat(start_of[word_of] - upto[:-1], n) + np.arange(upto[-1])]
    edges = upto[np.searchsorted(starts, offsets)]
    for i, a, b in zip(at.tolist(), edges[:-1], edges[1:], strict=True):
        out[i] = flat[a:b]
    return out


def _shards(path: str, folder: str, most: int):
    def run(batches):
        from pyspark import TaskContext

        part, attempt, shard = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        bits = max(1, (load(path).whole.get_vocab_size() - 1).bit_length())
        ids, docs, held = [], [], 0

        def flush():
            nonlocal ids, docs, held, shard
            name = f"{folder}/shard-{part:06d}-{shard:06d}-{attempt}.gwm"
            with open_shared(name, write=True) as out:
                size = write_matrix(out, np.concatenate(ids), bits, docs, [len(x) for x in ids])
            row = pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "path": name, "n_docs": len(docs), "n_tokens": held, "n_bytes": size}], schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))
            ids, docs, held, shard = [], [], 0, shard + 1
            return row

        for batch in small_batches(batches, most=SOME_TEXT):
            for doc, found in zip(batch.column("doc_id").to_pylist(), encode_texts(path, batch.column("text").to_pylist()), strict=True):
                if held and held + len(found) + 1 > most:
                    yield flush()
                ids.append(np.append(found, found.dtype.type(END)))
                docs.append(doc)
                held += len(found) + 1
        if docs:
            yield flush()

    return releasing(run)


def write_shards(docs: DataFrame, folder: str, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes docs (doc_id, text); returns the shards, with `before`, the ids in all shards before."""
    # the ranges are found before the texts are encoded, so nothing is encoded twice
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    dealt = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = materialise(dealt.mapInArrow(_shards(path or tokenizer_file(), folder, shard_tokens), MANIFEST), "token-shards")
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, ids (little-endian 32-bit integers) of each document, read from the files."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_shared(row["path"]) as f:
                    matrix = WaveletMatrix(f)
                    ids = matrix.tokens().astype("<u4")
                ends = np.cumsum(matrix.lengths, dtype=np.int64)
                starts = ends - np.array(matrix.lengths, dtype=np.int64)
                for i in range(0, len(ends), 1024):
                    j = min(len(ends), i + 1024)
                    parts = [ids[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(matrix.doc_ids[i:j], pa.int64()), pa.array(starts[i:j] + row["before"]), pa.array(parts, pa.binary())], names=["doc_id", "start", "ids"])

    n = max(1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return shards.repartition(n, "part", "shard").mapInArrow(releasing(run), "doc_id long, start long, ids binary")


def op10_token_files(spark, sf_dir: str) -> DataFrame:
    shards = write_shards(read_table(spark, sf_dir, "documents"), shared_dir(spark, "tokens"))
    out = read_shards(shards)
    # zlib's CRC-32, as Spark's crc32
    return out.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
