"""Exact top-k by inner product with the three-phase uniform threshold.

The components of the vectors are split into `LISTS` lists; an object's score is the sum of its partial scores in
all lists. For each query:

1. each list of each block of candidates gives its k best partial scores; the objects so found have real scores, and the k-th best
   of these over all blocks is a cutoff t that the k best of all cannot be below;
2. t goes to every block. An object whose score reaches t has a partial score of t / lists at least in some list, so the
   entries that reach this uniform threshold in some list are sufficient. Lists are looked at one after the other: what they have given so far
   and the lengths of what is left of both vectors bound an object's score, and where that is below t it is ruled out; once few are left no other list is multiplied;
3. the partial scores that the entries lack are added, so that their scores are exact, and those of t or more go on to
   the k best of each query.

Candidates stay where the scan puts them, as blocks of vectors in a task. The queries, in phase 2 with their cutoffs, are a table in the shared folder
that every task reads a batch at a time, so neither side is copied by a shuffle and nothing is broadcast; only the k best of a block and objects
that reach their cutoff are shuffled. Of rows with equal vectors only those of the k + 1 least ids can be among the k best of a
query, and of rows equal in both k suffice; others are set aside first, so a vector that a third of all rows hold costs as much as any other.

Rows. A null id or vector, or one with a null or non-finite component, takes no part. Rows that repeat an id are candidates of their own, but of no
query with that id; the rows of a repeated query share its k places, where each counts its candidates. Every finite component counts;
a table whose scores could leave 62 bits raises an error. Shorter vectors count as padded
with zeros. Equal scores are ordered by id. Fewer than k candidates give fewer rows; an empty table none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.common import materialise, read_table, releasing, shared_dir

LISTS = 4
#: Queries and candidates whose products are looked at together.
QUERIES_AT_ONCE = 256
CANDIDATES_AT_ONCE = 2048
#: Pairs are resolved one by one when fewer than one in so many are left.
FEW = 64
#: Bytes of the candidates that a task holds while the queries pass.
BLOCK_BYTES = 32 << 20
SCORES = "qid long, id long, score long"
NONE = np.iinfo(np.int64).min + 1


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """id, v: floor(256 * x) of every component."""
    x = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    kept = vectors.select(F.col("vec_id").cast("long").alias("id"), F.when(good, F.transform(x, lambda c: F.floor(c * 256).cast("long"))).alias("v"))
    return kept.where("v IS NOT NULL")


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix, padded with zeros."""
    offsets = np.asarray(column.offsets)
    size, values = np.diff(offsets), column.values.to_numpy()
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(offsets[0], offsets[-1]) - offsets[:-1][row]] = values[offsets[0] : offsets[-1]]
    return out


def blocks(batches, width: int):
    """(ids, matrix) of many rows at a time."""
    most, held, n = max(1, BLOCK_BYTES // (8 * width)), [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, most):
            part = batch.slice(i, most)
            if held and n + part.num_rows > most:
                yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held, n = [], 0
            held.append((part.column("id").to_numpy(), matrix_of(part.column("v"), width)))
            n += part.num_rows
    if held:
        yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def stored_queries(path: str, width: int):
    """(ids, matrix, cutoffs, whether there is one) of the queries in a table, some at a time."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    for batch in ds.dataset(place, filesystem=system, format="parquet").to_batches(columns=["id", "v", "t"], batch_size=QUERIES_AT_ONCE, batch_readahead=1, fragment_readahead=1, use_threads=False):
        if batch.num_rows:
            t = batch.column("t")
            yield batch.column("id").to_numpy(), matrix_of(batch.column("v"), width), t.fill_null(0).to_numpy(), np.asarray(t.is_valid())


def _products(q: np.ndarray, c: np.ndarray, exact: bool) -> np.ndarray:
    """By floating point where no sum can leave the integers that it holds."""
    return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if exact else q @ c.T


def _scores(q_ids, ids, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q_ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["qid", "id", "score"])


def _best(i: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of each i, ties to the least id."""
    order = np.lexsort((ids, -score, i))
    return order[np.arange(len(i)) - np.searchsorted(i[order], i[order]) < k]


def _local_lists(path: str, k: int, width: int, exact: bool):
    """Phase 1: the objects of the k best entries of each list, and of these the k best with their scores."""

    def run(batches):
        step = width // LISTS
        for c_ids, c in blocks(batches, width):
            for q_ids, q, _, _ in stored_queries(path, width):
                found = []
                for a in range(0, len(c), CANDIDATES_AT_ONCE):
                    part, ids = c[a : a + CANDIDATES_AT_ONCE], c_ids[a : a + CANDIDATES_AT_ONCE]
                    own, n = q_ids[:, None] == ids[None, :], min(k, len(part))
                    hit = np.zeros(own.shape, bool)
                    for j in range(LISTS):
                        p = _products(q[:, j * step : (j + 1) * step], part[:, j * step : (j + 1) * step], exact)
                        p[own] = NONE
                        np.put_along_axis(hit, np.argpartition(p, len(part) - n, axis=1)[:, len(part) - n :], True, 1)
                    i, x = np.nonzero(hit & ~own)
                    found.append((i, ids[x], np.einsum("ij,ij->i", q[i], part[x])))
                i, ids, score = (np.concatenate(x) for x in zip(*found, strict=True))
                kept = _best(i, ids, score, k)
                yield _scores(q_ids[i[kept]], ids[kept], score[kept])

    return run


def _entries(path: str, k: int, width: int, exact: bool):
    """Phases 2 and 3: objects that reach the uniform threshold in some list, with their scores where these reach t; of a block the k best."""

    def lengths(m: np.ndarray) -> list[np.ndarray]:
        """For each list the lengths of what the vectors have after it."""
        step = width // LISTS
        return [np.sqrt((m[:, (j + 1) * step :].astype(np.float64) ** 2).sum(1)) for j in range(LISTS)]

    def run(batches):
        step = width // LISTS
        for c_ids, c in blocks(batches, width):
            c_rest = lengths(c)
            for q_ids, q, t, has in stored_queries(path, width):
                q_rest, level = lengths(q), -(-t // LISTS)
                for a in range(0, len(c), CANDIDATES_AT_ONCE):
                    part, ids = c[a : a + CANDIDATES_AT_ONCE], c_ids[a : a + CANDIDATES_AT_ONCE]
                    alive = q_ids[:, None] != ids[None, :]
                    score, sent = np.zeros(alive.shape, np.int64), np.zeros(alive.shape, bool)
                    for j in range(LISTS):
                        p = _products(q[:, j * step : (j + 1) * step], part[:, j * step : (j + 1) * step], exact)
                        score += p
                        sent |= p >= level[:, None]
                        # what the lists to come can add, rounded up, in whole numbers: scores have digits that floats do not hold.
                        # A query that found fewer than k objects has no cutoff
                        rest = np.ceil(q_rest[j][:, None] * c_rest[j][None, a : a + CANDIDATES_AT_ONCE] * (1 + 1e-9)).astype(np.int64) + 1
                        alive &= (t[:, None] - score <= rest) | ~has[:, None]
                        if alive.sum() * FEW < alive.size:
                            break
                    i, x = np.nonzero(alive)
                    found = score[i, x]
                    if j + 1 < LISTS:  # what the entries left lack
                        more = np.stack([np.einsum("ij,ij->i", q[i, n * step : (n + 1) * step], part[x, n * step : (n + 1) * step]) for n in range(j + 1, LISTS)])
                        found, reach = found + more.sum(0), sent[i, x] | (more >= level[i]).any(0)
                    else:
                        reach = sent[i, x]
                    good = (reach & (found >= t[i])) | ~has[i]
                    i, x, found = i[good], x[good], found[good]
                    kept = _best(i, ids[x], found, k)
                    if len(kept):
                        yield _scores(q_ids[i[kept]], ids[x[kept]], found[kept])

    return run


def search(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row whose vec_id is divisible by `every`."""
    # k of the rows that agree in id and vector are enough
    counted = integer_vectors(vectors).groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    rows = materialise(counted, "topk-vectors")
    largest = F.array_max(F.transform("v", lambda c: F.abs(c.cast("double"))))
    width, largest = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(largest), F.lit(0.0))).first()
    # the cast of a component beyond 64 bits gives the largest long, which is refused here as well; so that the
    # difference of a cutoff and a score stays in 64 bits, neither passes 62
    if width * largest * largest >= 2.0**62:
        raise ValueError(f"{width} components of up to {largest:.0f} / 256 can have scores beyond 62 bits")
    exact = width * largest * largest < 2.0**53
    width = max(LISTS, -(-width // LISTS) * LISTS)
    each = lambda df: df.withColumn("_copy", F.explode(F.sequence(F.lit(1), "n"))).select("id", "v")
    of_vector = Window.partitionBy("v").orderBy("id")
    candidates = materialise(each(rows.withColumn("place", F.row_number().over(of_vector)).where(F.col("place") <= k + 1)), "topk-candidates")
    queries = each(rows.where(F.col("id") % every == 0))
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), "id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def stored(df: DataFrame, label: str) -> str:
        path = shared_dir(df.sparkSession, label)
        df.select("id", "v", "t").write.parquet(path)
        return path

    first = stored(queries.withColumn("t", F.lit(None).cast("long")), "topk-queries")
    seen = materialise(ranked(candidates.mapInArrow(releasing(_local_lists(first, k, width, exact)), SCORES)), "topk-lists")
    cuts = seen.where(F.col("rank") == k).select(F.col("qid").alias("id"), F.col("score").alias("t"))
    second = stored(queries.join(cuts, "id", "left"), "topk-cutoffs")
    found = candidates.mapInArrow(releasing(_entries(second, k, width, exact)), SCORES)
    return ranked(found).select(F.col("qid").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op9_topk(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"))
