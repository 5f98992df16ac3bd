r"""Removal of repeated passages by recompression.

Rounds of recompression give every text a shorter sequence of symbols. A round first names runs of one symbol, then
pairs: a symbol's coin makes it left or right, and each left that a right follows forms a pair with it. Names are hashes of what
they stand for, so they are the same in every text without any exchange, and whether a symbol arises depends on few
words around it. That range of words is kept with each symbol: two occurrences of a word sequence have the same symbols wherever the range
lies inside it.

After `ROUNDS` rounds, keys of `GRAM` symbols in a row are compared over the corpus. A key that is nowhere
else shows that no window of `WINDOW` words that holds its range is repeated. What windows are left, those
whose high-level symbols are all shared, are verified by hashes of all their words (64 bits, in buckets by other 64), compared over the
corpus in the same way; each word of a repeated window goes. Periodic texts and short ranges leave more windows to
verify, never fewer.

Blocks of whole documents are named by a hash of their bytes, so that the answers find them again; both exchanges
send packed keys (see shared_keys) and each document's text once. Documents without a window left to verify
are done after the first. An exchange reads its rows twice and must find them dealt and ordered alike, also where a lost
executor's part is read anew; a scan of files does so, anything else is written to the shared folder first.

Rows. Null text has no words. Any doc_id will do, null and repeated too. Repeated rows repeat each
other's windows. Texts of fewer than WINDOW words stay. A very long text is a block of its own. Empty tables give no rows.
Columns in `keep` come back as they are, but for one called as an output, which gives way to it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.llm.common import materialise, read_table, small_batches, text_or_empty, values_bytes
from glossweave.llm.shared_keys import SENT, arrange, buckets_for, flags, judge, send
from glossweave.llm.words import BASE, HASH_BYTES, INVERSE, hashed_words, mix, powers

#: What comes of each document; a kept column of such a name gives way to it.
OUTPUTS = ("n_words", "n_removed", "kept_sha256", "kept_text")
WINDOW = 35
ROUNDS = 3
GRAM = 3
BLOCK = 8 << 20
#: Bits of a symbol key that are sent; a bucket's number adds some. Too few only leave more to verify.
KEY_BITS = 40


def _odd(i: int) -> np.uint64:
    return mix(np.array([i], np.uint64) * np.uint64(BASE))[0] | np.uint64(1)


def words_of(data: np.ndarray, offsets: np.ndarray):
    """(hash of each word, first word of each text), a few megabytes at a time."""
    parts, firsts, n, i = [], [np.zeros(1, np.int64)], 0, 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + HASH_BYTES, "right")) - 1)
        h, _, _, f = hashed_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], False)
        parts.append(h)
        firsts.append(f[1:] + n)
        n, i = n + len(h), j
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(firsts)


def recompress(h: np.ndarray, firsts: np.ndarray, rounds: int = ROUNDS):
    """(symbols, low and high end of the words that each depends on, text of each).

    An end that depends on where the text ends lies one word outside it.
    """
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    s, lo = h, np.arange(len(h))
    hi = lo + 1

    def neighbours(text, lo, hi):
        """The dependence of the symbol before and after each one, or the outside of the text."""
        if not len(text):
            return lo, hi
        first, last = np.r_[True, text[1:] != text[:-1]], np.r_[text[1:] != text[:-1], True]
        before = np.where(first, firsts[text] - 1, np.r_[0, lo[:-1]])
        after = np.where(last, firsts[text + 1] + 1, np.r_[hi[1:], 0])
        return before, after

    for r in range(rounds):
        if not len(s):
            break
        # runs
        before, after = neighbours(text, lo, hi)
        head = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (text[1:] != text[:-1])])
        tail = np.r_[head[1:], len(s)] - 1
        n = (tail - head + 1).astype(np.uint64)
        lo, hi = np.minimum(before[head], lo[head]), np.maximum(after[tail], hi[tail])
        s, text = np.where(n > 1, mix(s[head] * _odd(3 * r + 1) + n), s[head]), text[head]
        # pairs
        left = (mix(s ^ _odd(100 + r)) & np.uint64(1)).astype(bool)
        before, after = neighbours(text, lo, hi)
        pair = np.zeros(len(s), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (text[1:] == text[:-1])
        second = np.r_[False, pair[:-1]]
        alone = ~pair & ~second
        low, high = np.where(alone & ~left, np.minimum(before, lo), lo), np.where(alone & left, np.maximum(after, hi), hi)
        at = np.flatnonzero(pair)
        name = s.copy()
        name[at] = mix(s[at] * _odd(3 * r + 2) + s[at + 1] * _odd(3 * r + 3))
        low[at], high[at] = np.minimum(lo[at], lo[at + 1]), np.maximum(hi[at], hi[at + 1])
        kept = ~second
        s, lo, hi, text = name[kept], low[kept], high[kept], text[kept]
    return s, lo, hi, text


def symbol_keys(h: np.ndarray, firsts: np.ndarray, window: int):
    """(key, low, high) of GRAM symbols in a row whose words lie in one text and fit a window."""
    s, lo, hi, text = recompress(h, firsts)
    n = max(0, len(s) - GRAM + 1)
    key = np.zeros(n, np.uint64)
    for k in range(GRAM):
        key += s[k : k + n] * _odd(50 + k)
    low, high = lo[:n].copy(), hi[:n].copy()
    for k in range(1, GRAM):
        low, high = np.minimum(low, lo[k : k + n]), np.maximum(high, hi[k : k + n])
    t = text[:n]
    good = (t == text[GRAM - 1 : GRAM - 1 + n]) & (low >= firsts[t]) & (high <= firsts[t + 1]) & (high - low <= window)
    return mix(key[good]), low[good], high[good]


def window_starts(firsts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Whether a window of one text begins at each word."""
    out = np.zeros(n, bool)
    sizes = np.diff(firsts)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, firsts[:-1][sizes >= window], 1)
    np.add.at(edge, (firsts[1:] - window + 1)[sizes >= window], -1)
    out[:] = np.cumsum(edge)[:n] > 0
    return out


def possible(h, firsts, window, low, high, shared) -> np.ndarray:
    """Where windows begin that hold no key that is alone."""
    n = len(h)
    edge = np.zeros(n + 2, np.int64)
    a, b = low[~shared], high[~shared]
    np.add.at(edge, np.maximum(0, b - window), 1)
    np.add.at(edge, a + 1, -1)
    return window_starts(firsts, n, window) & (np.cumsum(edge)[:n] == 0)


def window_keys(h: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the words of each window."""
    out = []
    for base, inverse, salt in ((BASE, INVERSE, 11), (0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64), 12)):
        x = mix(h ^ _odd(salt))
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(x * powers(base, len(x)) if len(x) else x, dtype=np.uint64, out=sums[1:])
        out.append(mix((sums[at + window] - sums[at]) * powers(inverse, len(h) + 1)[at]))
    return out[0], out[1]


def _name(data: np.ndarray, offsets: np.ndarray) -> int:
    import xxhash

    name = xxhash.xxh64(data.tobytes())
    name.update(offsets.tobytes())
    return name.intdigest() - (1 << 63)


def _ranges(mask: np.ndarray) -> bytes:
    """Set positions as starts and ends of runs."""
    return np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8))).astype("<i8").tobytes()


def _unranges(raw: bytes, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int8)
    at = np.frombuffer(raw, "<i8")
    edge[at[::2]] += 1
    edge[at[1::2]] -= 1
    return np.cumsum(edge)[:n] > 0


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(table: pa.Table) -> list[pa.RecordBatch]:
    return [b for raw in table.column("rows").to_pylist() for b in pa.ipc.open_stream(raw)]


def _packed_blocks(batches):
    """One row for each block of documents: its name and its rows."""
    for batch in small_batches(batches, most=BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array([_name(*values_bytes(batch.column("text")))], pa.int64()), pa.array([_pack(batch)], pa.binary())], names=["block", "rows"])


def _symbols_of(h, firsts, window, buckets):
    key, low, high = symbol_keys(h, firsts, window)
    return arrange(key & np.uint64((1 << KEY_BITS) - 1), key >> np.uint64(KEY_BITS), buckets), low, high


def _send_symbols(window, buckets):
    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in small_batches(batches, most=BLOCK):
            data, offsets = values_bytes(batch.column("text"))
            h, firsts = words_of(data, offsets)
            yield send(_name(data, offsets), _symbols_of(h, firsts, window, buckets)[0], packer)

    return run


def _find_possible(window, buckets, schema):
    """A block and its answers: documents that are done, and those with windows to verify."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for batch in _unpack(left):
            data, offsets = values_bytes(batch.column("text"))
            h, firsts = words_of(data, offsets)
            arranged, low, high = _symbols_of(h, firsts, window, buckets)
            maybe = possible(h, firsts, window, low, high, flags(arranged, right))
            open_ = [bool(maybe[a:b].any()) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
            ranges = [_ranges(maybe[a:b]) if o else None for a, b, o in zip(firsts[:-1], firsts[1:], open_, strict=True)]
            raw = data.tobytes()
            done = [None if o else hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b, o in zip(offsets[:-1].tolist(), offsets[1:].tolist(), open_, strict=True)]
            texts = pa.array([t if o else None for t, o in zip(batch.column("text").to_pylist(), open_, strict=True)], pa.string())
            kept = [batch.column(n) for n in batch.schema.names if n != "text"]
            out.append(pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(firsts), pa.int64()), pa.array(done, pa.string()), texts, pa.array(ranges, pa.binary())], schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return run


def _windows_of(batch: pa.RecordBatch, window: int, buckets: int):
    data, offsets = values_bytes(batch.column("text"))
    h, firsts = words_of(data, offsets)
    maybe = np.zeros(len(h), bool)
    for raw, a, b in zip(batch.column("ranges").to_pylist(), firsts[:-1], firsts[1:], strict=True):
        maybe[a:b] = _unranges(raw, int(b - a))
    at = np.flatnonzero(maybe)
    key, deal = window_keys(h, at, window)
    return data, offsets, firsts, at, arrange(key, deal, buckets)


def _send_windows(window, buckets):
    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in small_batches(batches, most=BLOCK):
            data, offsets, _, _, arranged = _windows_of(batch, window, buckets)
            yield send(_name(data, offsets), arranged, packer)

    return run


def _remove(window, buckets, schema, with_text):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for batch in _unpack(left):
            data, offsets, firsts, at, arranged = _windows_of(batch, window, buckets)
            edge = np.zeros(int(firsts[-1]) + window + 1, np.int64)
            gone = at[flags(arranged, right)]
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + window, -1)
            covered = np.cumsum(edge) > 0
            raw, removed, texts = data.tobytes(), [], []
            for a, b, f, g in zip(offsets[:-1].tolist(), offsets[1:].tolist(), firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
                removed.append(int(covered[f:g].sum()))
                texts.append(b" ".join(w for w, c in zip(raw[a:b].split(), covered[f:g].tolist(), strict=True) if not c))
            hashes = pa.array([hashlib.sha256(t).hexdigest() for t in texts])
            values = [batch.column(n) for n in batch.schema.names if n not in ("text", "ranges")] + [pa.array(removed, pa.int64()), hashes]
            values += [pa.array([t.decode() for t in texts], pa.string())] if with_text else []
            out.append(pa.RecordBatch.from_arrays(values, schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return run


def _arrow(fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType(fields))


def remove_repeats(docs: DataFrame, keep=("doc_id",), window: int = WINDOW, with_text: bool = False, scanned: bool = False) -> DataFrame:
    """The columns `keep` of docs, n_words, n_removed, kept_sha256, and kept_text of what is left if with_text.

    kept_text is the text itself, white space and all, where nothing was removed. scanned: docs is a plain scan of
    files, which gives the same rows in the same order each time; other rows may not, and are stored first.
    """
    keep = [c for c in keep if c.lower() not in OUTPUTS]
    # the kept columns cross by other names, so that one of them may be called as what is made on the way
    names = [f"kept_{i}" for i in range(len(keep))]
    kept = [T.StructField(n, docs.schema[c].dataType) for c, n in zip(keep, names, strict=True)]
    # both scans of an exchange read the same columns, so that Spark deals and orders their rows alike
    texts = docs.select(text_or_empty().alias("text"), *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)])
    if not scanned:
        texts = materialise(texts, "repeats-texts")
    buckets = buckets_for(texts)
    back = judge(texts.mapInArrow(_send_symbols(window, buckets), SENT))
    rows = texts.mapInArrow(_packed_blocks, "block long, rows binary")
    fields = [*kept, T.StructField("n_words", T.LongType()), T.StructField("done", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ranges", T.BinaryType())]
    judged = rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_find_possible(window, buckets, _arrow(fields)), T.StructType(fields))
    judged = materialise(judged, "repeats-possible")
    finished = judged.where("done IS NOT NULL").select(*names, "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("done").alias("kept_sha256"))
    left = judged.where("done IS NULL").select(*names, "n_words", "text", "ranges")
    answers = judge(left.mapInArrow(_send_windows(window, buckets), SENT))
    fields = [*kept, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    fields += [T.StructField("kept_text", T.StringType())] if with_text else []
    blocks = left.mapInArrow(_packed_blocks, "block long, rows binary")
    removed = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_remove(window, buckets, _arrow(fields), with_text), T.StructType(fields))
    whole = removed.unionByName(finished, allowMissingColumns=True)
    return whole.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], *[c for c in whole.columns if c not in names])


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), scanned=True).select("doc_id", "n_words", "n_removed", "kept_sha256")
