"""Product codes of integer vectors, whose entries are found by equal-average search.

A vector is cut into consecutive parts; each part position has a codebook, and a part's code is the index of its nearest
entry by squared Euclidean distance, ties to the lower index. The nearest entry is found by component sums: entries are sorted by
their sum, and from a part's own sum the search expands outward, to smaller and to larger sums. By Cauchy's inequality the squared gap of two
sums, over the dimension, is at most the squared distance, so a side ends where that strictly exceeds the best distance so far;
entries at the best distance itself are still looked at, for the tie. Parts of neighbouring sums go together, each leaving the search when its own bound is passed.

Codebooks begin as parts of the rows of the smallest ids. A round assigns every part of every row and replaces each entry by the
floor of its parts' mean. Spark runs a round as one scan: a task sums its parts for each entry, a group-by adds up what the tasks found,
and the codebooks, whose size does not follow the input, come to the driver and go with the next scan. All arithmetic is in whole numbers, so the
result does not depend on how rows are dealt.

Rows. A null vector, or one with a null or non-finite component, is left out. Other rows keep their place: null ids come
after all others, equal ids are ordered by their vectors, repeated rows count as often as they are there. Shorter vectors count as padded with
zeros to the longest, and all to a multiple of the number of parts. Fewer rows than entries give as many entries. Without rows there
are none and the codebooks are empty. Other columns are not looked at. A table whose distances or sums could leave 62 bits raises an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.llm.common import materialise, read_table, releasing
from glossweave.llm.topk import matrix_of
from glossweave.plans.storage import BROADCAST_BYTES, stored, stored_bytes

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Parts that are searched together, and entries that a side is extended by.
TOGETHER, STEP = 256, 8


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", label: str = "label") -> DataFrame:
    """id, label, v: floor(SCALE * x) of every component."""
    x = F.col("embedding").cast("array<double>")
    good = x.isNotNull() & F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    kept = vectors.select(F.col(id_column).alias("id"), F.col(label).alias("label"), F.when(good, F.transform(x, lambda c: F.floor(c * SCALE).cast("long"))).alias("v"))
    return kept.where("v IS NOT NULL")


def nearest(x: np.ndarray, book: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of each row of x. exact: floating point holds every product."""
    n, k = x.shape
    index, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not k:
        return index, best
    sums = book.sum(1)
    order = np.lexsort((np.arange(len(book)), sums))
    entries, sums = book[order], sums[order]
    wide = entries.astype(np.float64)
    squares = (entries * entries).sum(1)
    own = x.sum(1)
    rows = np.argsort(own, kind="stable")
    for at in range(0, n, TOGETHER):
        chunk = rows[at : at + TOGETHER]
        part, s = x[chunk], own[chunk]
        floats = part.astype(np.float64)
        part_squares = (part * part).sum(1)
        found, of = np.full(len(chunk), np.iinfo(np.int64).max // k), np.full(len(chunk), len(book))

        def look(live, a, b):
            products = (floats[live] @ wide[a:b].T).astype(np.int64) if exact else part[live] @ entries[a:b].T
            d = part_squares[live][:, None] - 2 * products + squares[a:b]
            least = d.min(1)
            first = np.where(d == least[:, None], order[a:b], len(book)).min(1)
            better = (least < found[live]) | ((least == found[live]) & (first < of[live]))
            found[live[better]], of[live[better]] = least[better], first[better]

        spots = np.searchsorted(sums, s)
        a, b = int(spots.min()), int(spots.max())
        if b > a:
            look(np.arange(len(chunk)), a, b)
        while a > 0 or b < len(book):
            # every part's sum lies between the entries at a - 1 and b, so its gaps only grow on either side
            if a > 0:
                live = np.flatnonzero((s - sums[a - 1]) ** 2 <= k * found)
                a, upto = (max(0, a - STEP), a) if len(live) else (0, 0)
                if upto:
                    look(live, a, upto)
            if b < len(book):
                live = np.flatnonzero((sums[b] - s) ** 2 <= k * found)
                b, since = (min(len(book), b + STEP), b) if len(live) else (len(book), len(book))
                if since < b:
                    look(live, since, b)
        index[chunk], best[chunk] = of, found
    return index, best


def _blocks(batches, width: int):
    for batch in batches:
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            yield part, matrix_of(part.column("v"), width)


def _sums(book: np.ndarray, exact: bool):
    """For each part position and entry, how many of the task's parts are nearest to it, and their sum."""
    parts, entries, k = book.shape

    def run(batches):
        count, total = np.zeros((parts, entries), np.int64), np.zeros(book.shape, np.int64)
        for _, m in _blocks(batches, parts * k):
            for p in range(parts):
                x = m[:, p * k : (p + 1) * k]
                index, _ = nearest(x, book[p], exact)
                count[p] += np.bincount(index, minlength=entries)
                np.add.at(total[p], index, x)
        p, e = np.nonzero(count)
        if len(p):
            sums = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * k, pa.int32()), pa.array(total[p, e].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), sums], names=["p", "e", "n", "sums"])

    return run


def _codes(book: np.ndarray, exact: bool):
    parts, _, k = book.shape

    def run(batches):
        for batch, m in _blocks(batches, parts * k):
            index, error = zip(*(nearest(m[:, p * k : (p + 1) * k], book[p], exact) for p in range(parts)), strict=True)
            code = [bytes(row).hex() for row in np.stack(index, 1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(sum(error), pa.int64())], names=["id", "label", "code", "error"])

    return run


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code and error of each row; the codebooks: part position, entry, component). entries: 256 at most."""
    rows = materialise(integer_vectors(vectors), "codes-vectors")
    largest = F.array_max(F.transform("v", lambda c: F.abs(c.cast("double"))))
    n, width, largest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(largest), F.lit(0.0))).first()
    width = -(-width // parts) * parts
    # the cast of a component beyond 64 bits gives the largest long, which is refused here as well
    if max(n * largest, (2.0 * width * largest) ** 2) >= 2.0**62:
        raise ValueError(f"{n} rows of {width} components of up to {largest:.0f} / {SCALE} can have distances or sums beyond 62 bits")
    exact = 4 * width * largest * largest < 2.0**53
    begin = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    book = np.zeros((len(begin), width), np.int64)
    for i, r in enumerate(begin):
        book[i, : len(r.v)] = r.v
    k = width // parts
    book = book.reshape(len(begin), parts, k).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(begin) and k else 0):
        sums = rows.mapInArrow(releasing(_sums(book, exact)), "p int, e int, n long, sums array<long>")
        for r in sums.groupBy("p", "e").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(k)]).alias("sums")).collect():
            book[r.p, r.e] = np.array(r.sums, np.int64) // r.n
    fields = [rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return rows.mapInArrow(releasing(_codes(book, exact)), T.StructType(fields)), book


def digest(book: np.ndarray) -> str:
    """Of all components, by part position, entry and place in it."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """coded with label_error, the errors of all rows of its label, which may be null. No label's rows meet: they are summed where they lie."""
    coded = materialise(coded, "codes-coded")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    small = stored_bytes(sums) <= BROADCAST_BYTES
    return coded.join(F.broadcast(sums) if small else sums, coded["label"].eqNullSafe(sums["label"])).select(coded["id"], coded["label"], "code", "error", "label_error")


def op13_codes(spark, sf_dir: str) -> DataFrame:
    coded, book = compress(read_table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The query for DuckDB, by comparing every part with every entry."""
    steps = [
        f"""kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
cut AS (SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) t(p)),
b0 AS (SELECT p, r - 1 AS e, x FROM cut WHERE r <= {entries})"""
    ]
    near = """SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT c.r, c.p, b.e, (list_dot_product(c.x::DOUBLE[], c.x::DOUBLE[]) - 2 * list_dot_product(c.x::DOUBLE[], b.x::DOUBLE[]) + list_dot_product(b.x::DOUBLE[], b.x::DOUBLE[]))::BIGINT AS d
  FROM cut c JOIN b{0} b ON b.p = c.p) GROUP BY r, p"""
    for i in range(rounds):
        steps.append(f"a{i} AS ({near.format(i)})")
        steps.append(f"""m{i} AS (SELECT p, e, list(floor(s::DOUBLE / n)::BIGINT ORDER BY i) AS x FROM (
  SELECT a.p, a.e, i, sum(c.x[i]) AS s, count(*) AS n FROM a{i} a JOIN cut c ON c.r = a.r AND c.p = a.p, range(1, len(c.x) + 1) t(i) GROUP BY a.p, a.e, i) GROUP BY p, e)""")
        steps.append(f"b{i + 1} AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m ON m.p = b.p AND m.e = b.e)")
    steps.append(f"last AS ({near.format(rounds)})")
    steps.append("coded AS (SELECT k.vec_id, k.label, string_agg(printf('%02x', l.e), '' ORDER BY l.p) AS code, sum(l.d)::BIGINT AS error FROM last l JOIN kept k USING (r) GROUP BY k.r, k.vec_id, k.label)")
    steps.append(f"book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT h FROM book) AS codebooks_sha256 FROM coded"
