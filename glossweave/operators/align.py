"""From two tokenised sentences to translation facts.

A sentence pair stays in one row, as arrays, up to its facts: links, groups, spans and candidates are narrow. The
only joins before counting are the lookups of listed words.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.config import BE_FORMS, MAX_PHRASE, SUBWORD_LIMIT, Negators, PairConfig
from glossweave.plans.storage import lookup, stored, stored_bytes

LINKS = "array<struct<i:int,j:int>>"
GROUPS = "array<struct<src:array<int>,trg:array<int>>>"
#: Bytes of a word list as a stored table up to which every task holds it.
LIST_BYTES = 64 << 20
#: Bytes of the table of vectors up to which every task holds it.
VECTOR_BYTES = 128 << 20
VECTOR_COLUMNS = ("n1", "n2", "v1", "v2")
#: Lengths that sentences are padded to.
PADDED = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024])
#: Words of either side in a tile of products, and pairs of words that go on together.
TILE = 1024
PAIRS_AT_ONCE = 1 << 16


def pieces(words: Column, size: int, limit: int | None = None) -> Column:
    """Array of (word_idx, piece): words cut into pieces of `size` characters; of a sentence the first `limit`."""
    cut = F.flatten(F.transform(words, lambda w, i: F.transform(F.sequence(F.lit(0), F.floor((F.length(w) - 1) / size).cast("int")), lambda k: F.struct(i.cast("int").alias("word_idx"), F.substring(w, k * size + 1, F.lit(size)).alias("piece")))))
    return cut if limit is None else F.slice(cut, 1, limit)


def subword_map(df: DataFrame, size: int) -> DataFrame:
    """Splits words into pieces of `size` characters: sub_idx over the sentence, word_idx, piece. df: row_pos, toks (words)."""
    return df.select("row_pos", F.posexplode(pieces(F.col("toks"), size)).alias("sub_idx", "p")).select("row_pos", "sub_idx", "p.word_idx", "p.piece")


def subword_truncate(subwords: DataFrame, limit: int = SUBWORD_LIMIT) -> DataFrame:
    """Only what an encoder takes."""
    return subwords.where(F.col("sub_idx") < limit)


def _probabilities(dots: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Softmax over the other side's tokens for each row, and for each column."""
    e1, e2 = np.exp((dots - dots.max(1, keepdims=True)) * scale), np.exp((dots - dots.max(0, keepdims=True)) * scale)
    return e1 / e1.sum(1, keepdims=True), e2 / e2.sum(0, keepdims=True)


def tiles(u: np.ndarray, v: np.ndarray, scale: float | None, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """(first row, first column, products, both probabilities) of u @ v.T, a tile at a time; without a scale no probabilities.

    The maxima and the sums of the exponentials of whole rows and columns come from a first pass over the tiles, each new maximum scaling the sum so far. So what is
    held at once is a tile and four vectors, however long the sentences are.
    """
    size = size or TILE
    if len(u) <= size and len(v) <= size:
        dots = u @ v.T
        yield 0, 0, dots, *(_probabilities(dots, scale) if scale is not None else (None, None))
        return
    places = [(a, b) for a in range(0, len(u), size) for b in range(0, len(v), size)]
    product = lambda a, b: u[a : a + size] @ v[b : b + size].T
    tops, sums = [np.full(len(x), -np.inf) for x in (u, v)], [np.zeros(len(x)) for x in (u, v)]
    for a, b in places if scale is not None else ():
        dots = product(a, b)
        for side, (at, across) in enumerate(((slice(a, a + size), 1), (slice(b, b + size), 0))):
            top = np.maximum(tops[side][at], dots.max(across))
            sums[side][at] = sums[side][at] * np.exp((tops[side][at] - top) * scale) + np.exp((dots - np.expand_dims(top, across)) * scale).sum(across)
            tops[side][at] = top
    for a, b in places:
        dots = product(a, b)
        if scale is None:
            yield a, b, dots, None, None
            continue
        rows, columns = slice(a, a + size), slice(b, b + size)
        yield a, b, dots, np.exp((dots - tops[0][rows, None]) * scale) / sums[0][rows, None], np.exp((dots - tops[1][None, columns]) * scale) / sums[1][None, columns]


def linked(u: np.ndarray, v: np.ndarray, scale: float, threshold: float, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns, in their order, where both probabilities are above the threshold."""
    found = [(a + i, b + j) for a, b, _, p1, p2 in tiles(u, v, scale, size) for i, j in [np.nonzero((p1 > threshold) & (p2 > threshold))]]
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((j, i)) if len(found) > 1 else slice(None)
    return i[order], j[order]


def _flat(column: pa.Array) -> tuple[list[int], np.ndarray]:
    """Offsets of a list column and its values; null rows are empty."""
    offsets = np.asarray(column.offsets)
    if column.null_count:
        sizes = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        return _flat(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), column.flatten()))
    return offsets.tolist(), column.values.to_numpy(zero_copy_only=False)


def _kept(column: pa.Array, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of each row, positions in their rows, places) of the tokens of a list column that have a vector, which are those with a place from 0."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    kept = np.flatnonzero(place >= 0)
    row = np.repeat(np.arange(len(sizes)), sizes)[kept]
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))]), kept - first[row], place[kept]


def vectors_at_hand(rows: DataFrame, vectors: DataFrame):
    """(rows, sides): sides(batch) gives, for both sides, (offsets of each row, positions, places, matrix) of the tokens that have vectors; places are rows of the matrix.

    A table of vectors up to VECTOR_BYTES, whole numbers as short as they fit, goes to every task, and nothing is shuffled; a larger one is joined to the rows.
    """
    known = vectors.where("vec_id IS NOT NULL AND vec IS NOT NULL")
    whole = isinstance(vectors.schema["vec"].dataType.elementType, T.IntegralType)
    most = F.max(F.greatest(F.abs(F.array_max("vec")), F.abs(F.array_min("vec")))) if whole else F.lit(None)
    n, width, most = known.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0)), most).first()
    kind, size = next(((k, b) for k, b in (("smallint", 2), ("int", 4)) if whole and most is not None and most < 1 << (8 * b - 1)), (None, 8))
    if n * width * size > VECTOR_BYTES:

        def joined(batch):
            sides = []
            for k in (1, 2):
                column = batch.column(batch.schema.get_field_index(f"v{k}"))
                sizes, each = _nested(column)
                matrix = each.field("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                sides.append((np.concatenate([[0], np.cumsum(sizes)]), each.field("idx").to_numpy(zero_copy_only=False).astype(np.int64), np.arange(len(each)), matrix.reshape(len(each), -1) if len(each) else np.zeros((0, 1))))
            return sides

        return with_vectors(rows, known), joined
    found = known.select("vec_id", F.col("vec").cast(f"array<{kind}>") if kind else "vec").toArrow().sort_by("vec_id")
    matrix = np.stack([x.values.to_numpy(zero_copy_only=False) for x in found.column("vec").combine_chunks()]) if n else np.zeros((0, 1))
    table = rows.sparkSession.sparkContext.broadcast((found.column("vec_id").to_numpy(), matrix))

    def at_hand(batch):
        ids, matrix = table.value
        sides = []
        for k in (1, 2):
            column = batch.column(batch.schema.get_field_index(f"n{k}"))
            wanted = column.flatten().to_numpy(zero_copy_only=False)
            place = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1) if len(ids) else np.full(len(wanted), -1)
            sides.append((*_kept(column, np.where(ids[place] == wanted, place, -1) if len(ids) else place), matrix))
        return sides

    return rows, at_hand


def _row_pairs(sides) -> Iterator[tuple[tuple[np.ndarray, np.ndarray], ...]]:
    """(positions, matrix) of both sides for each row."""
    for r in range(len(sides[0][0]) - 1):
        yield tuple((at[offsets[r] : offsets[r + 1]], matrix[place[offsets[r] : offsets[r + 1]]].astype(np.float64)) for offsets, at, place, matrix in sides)


def batch_products(sides, scale: float | None) -> Iterator[tuple[np.ndarray, int, int, np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """(rows, first word of either side, products and both probabilities of these rows, padded) of all rows of a batch; what tiles() gives for each row.

    Rows of about one length are multiplied together, padded to it: products there are minus infinity. A long row, of more than PAIRS_AT_ONCE pairs, is taken alone, in tiles.
    """
    sizes = [np.diff(offsets) for offsets, *_ in sides]
    place = [np.searchsorted(PADDED, n) for n in sizes]
    alone = (sizes[0] * sizes[1] > PAIRS_AT_ONCE) | (place[0] == len(PADDED)) | (place[1] == len(PADDED))
    some_words = (sizes[0] > 0) & (sizes[1] > 0)
    rows = np.flatnonzero(some_words & ~alone)
    rows = rows[np.lexsort((place[1][rows], place[0][rows]))]
    for some in np.split(rows, np.flatnonzero(np.diff(place[0][rows] * 1000 + place[1][rows])) + 1) if len(rows) else ():
        width = [PADDED[x[some[0]]] for x in place]
        for at in range(0, len(some), step := max(1, PAIRS_AT_ONCE // (width[0] * width[1]))):
            of, vectors, there = some[at : at + step], [], []
            for (offsets, _, places, matrix), n, w in zip(sides, sizes, width, strict=True):
                inside = np.arange(w) < n[of][:, None]
                token = np.where(inside, offsets[of][:, None] + np.arange(w), 0)
                vectors.append(matrix[places[token]].astype(np.float64))
                there.append(inside)
            dots = np.where(there[0][:, :, None] & there[1][:, None, :], vectors[0] @ vectors[1].transpose(0, 2, 1), -np.inf)
            if scale is None:
                yield of, 0, 0, dots, None, None
                continue
            with np.errstate(invalid="ignore"):
                e1, e2 = (np.exp((dots - dots.max(k, keepdims=True)) * scale) for k in (2, 1))
                # what is padded is no number on one side, and so above no threshold
                yield of, 0, 0, dots, e1 / e1.sum(2, keepdims=True), e2 / e2.sum(1, keepdims=True)
    for r in np.flatnonzero(alone & some_words):
        u, v = (matrix[place[offsets[r] : offsets[r + 1]]].astype(np.float64) for offsets, _, place, matrix in sides)
        for a, b, dots, *probs in tiles(u, v, scale):
            yield np.array([r]), a, b, dots[None], *(p if p is None else p[None] for p in probs)


def batch_links(sides, scale: float, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, i, j) in order, of all links of a batch: as linked() gives them for each row."""
    parts = []
    for of, a, b, _, p1, p2 in batch_products(sides, scale):
        r, i, j = np.nonzero((p1 > threshold) & (p2 > threshold))
        parts.append((of[r], a + i, b + j))
    row, i, j = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
    order = np.lexsort((j, i, row))
    row, i, j = row[order], i[order], j[order]
    return row, *(at[offsets[row] + x] for (offsets, at, *_), x in zip(sides, (i, j), strict=True))


def pair_products(rows: DataFrame, vectors: DataFrame, scale: float | None = None, threshold: float | None = None) -> DataFrame:
    """row_pos, i, j, dot for every pair of words of a sentence pair that have vectors, and with a scale p1 and p2; with a threshold, only
    pairs both of whose probabilities are above it leave the task.

    rows: row_pos, n1, n2 (the vectors' ids). Sentence pairs are multiplied where they lie, those of a batch together.
    """
    rows, sides = vectors_at_hand(rows.select("row_pos", "n1", "n2"), vectors)
    names = ["row_pos", "i", "j", "dot"] + (["p1", "p2"] if scale is not None else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = lambda parts: pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=names)
        for batch in batches:
            parts, n, row_pos = [], 0, batch.column(batch.schema.get_field_index("row_pos")).to_numpy(zero_copy_only=False)
            (first1, at1, *_), (first2, at2, *_) = both = sides(batch)
            for of, a, b, dots, *probs in batch_products(both, scale):
                r, i, j = at = np.nonzero(np.isfinite(dots) if threshold is None else (probs[0] > threshold) & (probs[1] > threshold))
                row = of[r]
                if len(r):
                    parts.append([row_pos[row], at1[first1[row] + a + i].astype(np.int32), at2[first2[row] + b + j].astype(np.int32), dots[at].astype(np.int64), *(p[at] for p in probs if p is not None)])
                n += len(r)
                if n >= PAIRS_AT_ONCE:
                    yield joined(parts)
                    parts, n = [], 0
            if parts:
                yield joined(parts)

    return rows.mapInArrow(run, "row_pos long, i int, j int, dot long" + (", p1 double, p2 double" if scale is not None else ""))


def dot_product(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """row_pos, i, j, dot for every pair of words of a sentence pair. rows: row_pos, n1, n2; vectors: vec_id, vec of whole numbers."""
    return pair_products(rows, vectors)


def bi_softmax(rows: DataFrame, vectors: DataFrame, scale: float, threshold: float | None = None) -> DataFrame:
    """With p1, over the other side's tokens for each i, and p2, for each j; with a threshold, of pairs that link_threshold keeps."""
    return pair_products(rows, vectors, scale, threshold)


def link_threshold(probs: DataFrame, threshold: float) -> DataFrame:
    """Links: both probabilities above the threshold."""
    return probs.where((F.col("p1") > threshold) & (F.col("p2") > threshold)).select("row_pos", "i", "j")


def link_order(links: DataFrame) -> DataFrame:
    """The links of each sentence pair in order of the first side, then the second."""
    return links.groupBy("row_pos").agg(F.sort_array(F.collect_list(F.struct("i", "j"))).alias("links"))


def grouped_links(links, components: bool = False) -> list[tuple[list[int], list[int]]]:
    """Groups of linked words, from links (i, j) in order.

    Two new words begin a group; a known word takes a new one into its group; a link between words of two groups is ignored, or with
    components joins them.
    """
    groups, of_src, of_trg = [], {}, {}
    for i, j in links:
        a, b = of_src.get(i), of_trg.get(j)
        if a is None and b is None:
            a = b = len(groups)
            groups.append(([], []))
        elif a is None or b is None:
            a = b = b if a is None else a
        elif a != b and components:
            for x in groups[b][0]:
                of_src[x] = a
            for y in groups[b][1]:
                of_trg[y] = a
            groups[a][0].extend(groups[b][0])
            groups[a][1].extend(groups[b][1])
            groups[b] = ([], [])
            continue
        else:
            continue
        if i not in of_src:
            of_src[i] = a
            groups[a][0].append(i)
        if j not in of_trg:
            of_trg[j] = b
            groups[b][1].append(j)
    return [(sorted(src), sorted(trg)) for src, trg in groups if src]


def _lists(row: np.ndarray, values: np.ndarray | pa.Array, n: int) -> pa.ListArray:
    """Values as lists of n rows; row: the row of each, in order."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values if isinstance(values, pa.Array) else pa.array(values.astype(np.int32)))


def in_turn(row: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct links, each where it first stands."""
    wide = int(max(i.max(initial=0), j.max(initial=0))) + 1
    first = np.sort(np.unique((row * wide + i) * wide + j, return_index=True)[1])
    return row[first], i[first], j[first]


def link_columns(row: np.ndarray, i: np.ndarray, j: np.ndarray, n: int, components: bool = False) -> list[pa.Array]:
    """The links and groups of n rows as Arrow columns, from all distinct links (row, i, j), by row and within it in turn. Groups are what grouped_links makes of each row's links.

    Where words of side 1 come in order, one enters the group of its first link's word of side 2, which is that of the first word of side 1 linked with it; so parents are followed to their ends.
    """
    links = _lists(row, pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (i, j)], names=["i", "j"]), n)
    if components or (np.diff(i)[np.diff(row) == 0] < 0).any():
        starts = np.searchsorted(row, np.arange(n + 1))
        found = [grouped_links(zip(i[a:b].tolist(), j[a:b].tolist(), strict=True), components) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        of = np.repeat(np.arange(n), [len(x) for x in found])
        members = [pa.array([g[k] for x in found for g in x], pa.list_(pa.int32())) for k in (0, 1)]
        return [links, _lists(of, pa.StructArray.from_arrays(members, names=["src", "trg"]), n)]
    wide = int(max(i.max(initial=0), j.max(initial=0))) + 1
    src, first = np.unique(row * wide + i, return_index=True)
    trg, owner = np.unique(row * wide + j, return_index=True)
    # for each word of side 1 the place of the first word of side 1 that its first link's other word is linked with
    root = np.searchsorted(src, (row * wide + i)[owner[np.searchsorted(trg, (row * wide + j)[first])]])
    while (root[root] != root).any():
        root = root[root]
    groups, of_src = np.unique(root, return_inverse=True)
    of_trg = of_src[np.searchsorted(src, (row * wide + i)[owner])]
    members = [_lists(of[order], (x % wide)[order], len(groups)) for of, x in ((of_src, src), (of_trg, trg)) for order in [np.lexsort((x, of))]]
    return [links, _lists(src[groups] // wide, pa.StructArray.from_arrays(members, names=["src", "trg"]), n)]


def sentence_links(rows: DataFrame, vectors: DataFrame, scale: float, threshold: float, components: bool = False) -> DataFrame:
    """rows with links and groups in place of n1 and n2, the vectors' ids of both sides' pieces, and of s1 and s2 if they are there.

    links: pairs of words both of whose probabilities are above the threshold. With s1 and s2 the vectors are those of subwords, and these columns say
    to which word each belongs: links are then enumerated by subwords and mapped to words. groups: what grouped_links makes of them.
    Pieces without a vector have no links.
    """
    rows, sides = vectors_at_hand(rows, vectors)
    fields = [f for f in rows.schema.fields if f.name not in (*VECTOR_COLUMNS, "s1", "s2")]
    schema = T.StructType([*fields, T.StructField("links", T.DataType.fromDDL(LINKS)), T.StructField("groups", T.DataType.fromDDL(GROUPS))])
    return rows.mapInArrow(in_steps(lambda: [link_step(sides, scale, threshold, components)]), schema)


def in_steps(steps):
    """What mapInArrow takes of steps, functions from a batch to a batch, which steps() makes for each task: so what some of them pass on never leaves the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = steps()
        for batch in batches:
            for step in found:
                batch = step(batch)
            yield batch

    return run


def link_step(sides, scale: float, threshold: float, components: bool = False):
    """sentence_links of a batch; sides as vectors_at_hand gives them."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, i, j = batch_links(sides(batch), scale, threshold)
        if "s1" in batch.schema.names:
            words = [_flat(batch.column(batch.schema.get_field_index(f"s{k}"))) for k in (1, 2)]
            i, j = (of[np.asarray(offsets)[row] + x].astype(np.int64) for (offsets, of), x in zip(words, (i, j), strict=True))
            row, i, j = in_turn(row, i, j)
        columns = link_columns(row, i, j, batch.num_rows, components)
        kept = [n for n in batch.schema.names if n not in (*VECTOR_COLUMNS, "s1", "s2")]
        return pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in kept], *columns], names=[*kept, "links", "groups"])

    return step


def with_vectors(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """rows with v1 and v2, arrays of (idx, vec) in order, by a join on the vectors' ids. rows have a unique row_pos."""
    for k in (1, 2):
        each = rows.select("row_pos", F.posexplode(f"n{k}").alias("idx", "vec_id")).join(vectors, "vec_id")
        rows = rows.join(each.groupBy("row_pos").agg(F.sort_array(F.collect_list(F.struct("idx", "vec"))).alias(f"v{k}")), "row_pos", "left")
    return rows


def negated(words: Column, negators: tuple[Negators, ...]) -> Column:
    """Positions that a negator makes count for nothing."""

    def of(n: Negators) -> Column:
        at = F.transform(words, lambda w, i: F.when(w.isin(*n.words), (i + n.offset).cast("int")))
        return F.filter(at, lambda x: x.isNotNull())

    return F.concat(F.array().cast("array<int>"), *[of(n) for n in negators])


def be_before_verb(words: Column, pos: Column) -> Column:
    """Positions of a form of "be" that a verb follows directly."""
    at = F.transform(words, lambda w, i: F.when(w.isin(*BE_FORMS) & (F.get(pos, i + 1) == "v"), i.cast("int")))
    return F.filter(at, lambda x: x.isNotNull())


def collapsed(at: Column, words: Column, pos: Column, joiner: str) -> Column:
    """Elements (word, pos) of a group's side: from the first to the last content word they become one.

    at: sorted positions; words and pos of the sentence. Words are joined by the joiner, codes by /; function words outside stay.
    """
    item = lambda i: F.struct(F.get(words, i).alias("word"), F.get(pos, i).alias("pos"))
    items = F.transform(at, item)
    n = F.size(at)
    content = F.filter(F.transform(items, lambda t, k: F.when(t["pos"] != "", k + 1)), lambda k: k.isNotNull())
    a, b = F.array_min(content), F.array_max(content)
    middle = F.slice(items, a, b - a + 1)
    codes = F.array_join(F.filter(F.transform(middle, lambda t: t["pos"]), lambda p: p != ""), "/")
    one = F.struct(F.array_join(F.transform(middle, lambda t: t["word"]), joiner).alias("word"), codes.alias("pos"))
    joined = F.concat(F.slice(items, F.lit(1), a - 1), F.array(one), F.slice(items, b + 1, n - b))
    # most sides are one word, and then nothing of this is looked at
    return F.when(n == 1, F.array(item(F.get(at, F.lit(0))))).when(F.size(content) > 1, joined).otherwise(items)


def head_codes(elements1: Column, elements2: Column) -> Column:
    """Codes that the last content elements of both sides share, in order."""

    def codes(elements):
        head = F.try_element_at(F.filter(elements, lambda t: t["pos"] != ""), F.lit(-1))
        return F.coalesce(F.split(head["pos"], "/"), F.array().cast("array<string>"))

    # a function word alone on either side, or two single words of one code, need no sets
    none, first = F.array().cast("array<string>"), lambda e: F.get(e, F.lit(0))["pos"]
    single = (F.size(elements1) == 1) & (F.size(elements2) == 1) & ~F.contains(first(elements1), F.lit("/")) & ~F.contains(first(elements2), F.lit("/"))
    alone = F.when((first(elements1) == first(elements2)) & (first(elements1) != ""), F.array(first(elements1))).otherwise(none)
    return F.when(single, alone).otherwise(F.sort_array(F.array_distinct(F.filter(F.array_intersect(codes(elements1), codes(elements2)), lambda p: p != ""))))


def phrase_candidates(elements: Column, joiner: str, most: int = MAX_PHRASE) -> Column:
    """All ordered choices of up to `most` elements (three at most) with the head among them: (idx, phrase), longest first, then by idx."""
    n = F.size(elements)
    heads = F.filter(F.transform(elements, lambda t, k: F.when(t["pos"] != "", k)), lambda k: k.isNotNull())
    head = F.array_max(heads)
    places = F.transform(elements, lambda t, k: k)
    others = F.filter(places, lambda k: k != head)
    one = F.array(F.array(head))
    two = F.transform(others, lambda k: F.sort_array(F.array(k, head)))
    three = F.flatten(F.transform(others, lambda k: F.transform(F.filter(others, lambda m: m > k), lambda m: F.sort_array(F.array(k, m, head)))))
    by_length = F.concat(*[F.sort_array(three), F.sort_array(two), one][3 - min(3, max(1, most)) :])
    phrase = lambda idx: F.array_join(F.transform(idx, lambda k: F.get(elements, k)["word"]), joiner)
    return F.when(head.isNotNull() & (n > 0), F.transform(by_length, lambda idx: F.struct(idx.alias("idx"), phrase(idx).alias("phrase"))).cast("array<struct<idx:array<int>,phrase:string>>")).otherwise(F.array().cast("array<struct<idx:array<int>,phrase:string>>"))


def longest_match(candidates: DataFrame, listed: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """The first listed candidate of each group and side, with all usable codes it is listed under.

    overrides: pos, surface, normalized: the listed form of a phrase, before what norms say.

    candidates: row_pos, g, side, place (0 is the longest and first), phrase, norms: array of (pos, norm) for each usable
    code. listed: pos, word, id. Gives row_pos, g, side, phrase, found: array of (pos, norm, id) by code.
    """
    each = candidates.select("row_pos", "g", "side", "place", "phrase", F.explode("norms").alias("n")).select("row_pos", "g", "side", "place", "phrase", "n.pos", F.col("n.norm").alias("word"))
    if overrides is not None:
        over = overrides.select("pos", F.col("surface").alias("phrase"), "normalized")
        each = lookup(each, over, ["pos", "phrase"]).withColumn("word", F.coalesce("normalized", "word")).drop("normalized")
    hits = lookup(each, listed, ["pos", "word"], "inner")
    # a group's hits are few: those of its first listed place are taken from all, so one shuffle does
    every = hits.groupBy("row_pos", "g", "side").agg(F.sort_array(F.collect_list(F.struct("place", "pos", F.col("word").alias("norm"), "id", "phrase"))).alias("hits"))
    first = F.filter("hits", lambda h: h["place"] == F.col("hits")[0]["place"])
    found = F.transform(first, lambda h: F.struct(h["pos"].alias("pos"), h["norm"].alias("norm"), h["id"].alias("id")))
    return every.select("row_pos", "g", "side", F.col("hits")[0]["phrase"].alias("phrase"), found.alias("found"))


def emit_facts(matches: DataFrame) -> DataFrame:
    """One fact for each code that both sides of a group were found under: row_pos, g, pos, id1, word1, norm1, id2, word2, norm2."""
    side = lambda k: matches.where(F.col("side") == k).select("row_pos", "g", F.col("phrase").alias(f"word{k}"), F.explode("found").alias("f")).select("row_pos", "g", f"word{k}", "f.pos", F.col("f.norm").alias(f"norm{k}"), F.col("f.id").alias(f"id{k}"))
    return side(1).join(side(2), ["row_pos", "g", "pos"]).select("row_pos", "g", "pos", "id1", "word1", "norm1", "id2", "word2", "norm2")


def antonym_filter(facts: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Facts whose normalised words are not an exception pair (norm1, norm2)."""
    return lookup(facts, exceptions, ["norm1", "norm2"], "left_anti")


ELEMENTS = "array<struct<word:string,pos:string>>"


def _ignored(words: pa.Array, pos: pa.Array | None, row: np.ndarray, negators: tuple[Negators, ...]) -> np.ndarray:
    """Of the flat words of a batch's rows, those at positions of negated and, with pos, be_before_verb."""
    is_in = lambda some: pc.fill_null(pc.is_in(words, value_set=pa.array(some, pa.string())), False).to_numpy(zero_copy_only=False)
    out = np.zeros(len(words), bool)
    for n in negators:
        at = np.flatnonzero(is_in(n.words))
        to = at + n.offset
        inside = (to >= 0) & (to < len(words))
        at, to = at[inside], to[inside]
        out[to[row[at] == row[to]]] = True
    if pos is not None and len(words):
        verb = pc.fill_null(pc.equal(pos, "v"), False).to_numpy(zero_copy_only=False)
        out[:-1] |= is_in(BE_FORMS)[:-1] & verb[1:] & (row[1:] == row[:-1])
    return out


def _elements(words: pa.Array, pos: pa.Array, member: np.ndarray, group: np.ndarray, n: int, joiner: str) -> tuple[pa.Array, np.ndarray]:
    """(what collapsed makes of each of n groups, which members are content words). member: places of a group's words in words and pos."""
    word, code = words.take(pa.array(member)), pos.take(pa.array(member))
    content = pc.fill_null(pc.not_equal(code, ""), False).to_numpy(zero_copy_only=False)
    at = np.arange(len(member))
    last, first = np.full(n, -1), np.full(n, len(member))
    np.maximum.at(last, group[content], at[content])
    np.minimum.at(first, group[content], at[content])
    inside = (at >= first[group]) & (at <= last[group])
    follows = inside & (at > first[group])
    begins = np.flatnonzero(~follows)
    # groups with more than one content word, and the words from the first to the last of these
    joined = np.unique(group[follows])
    of = np.flatnonzero(inside & np.isin(group, joined))
    texts, codes = [_lists(np.searchsorted(joined, group[x]), y.take(pa.array(x)), len(joined)) for x, y in ((of[np.asarray(word.is_valid())[of]], word), (of[content[of]], code))]
    place = begins.copy()
    place[np.isin(begins, first[joined])] = len(member) + np.arange(len(joined))
    item = lambda own, more, by: pa.concat_arrays([own, pc.binary_join(more, by).cast(pa.string())]).take(pa.array(place))
    return _lists(group[begins], pa.StructArray.from_arrays([item(word, texts, joiner), item(code, codes, "/")], names=["word", "pos"]), n), content


def _codes_shared(sides: list[tuple[np.ndarray, pa.Array]], n: int) -> pa.Array:
    """For each of n groups the codes that content words of both sides have, in order. sides: (group, code) of the content words; a code of several is joined by /."""
    coded = [code.dictionary_encode() for _, code in sides]
    single = [[[c for c in x.split("/") if c] for x in c.dictionary.to_pylist()] for c in coded]
    every = sorted({c for side in single for x in side for c in x})
    bit = {c: 1 << k for k, c in enumerate(every)}
    kind = np.int64 if len(every) < 63 else object
    masks = []
    for (group, _), c, codes in zip(sides, coded, single, strict=True):
        mask = np.zeros(n, kind)
        np.bitwise_or.at(mask, group, np.array([sum(bit[x] for x in set(some)) for some in codes], kind)[c.indices.to_numpy()] if len(codes) else np.zeros(0, kind))
        masks.append(mask)
    found, of = np.unique(masks[0] & masks[1], return_inverse=True)
    return pa.array([[c for c in every if m & bit[c]] for m in found.tolist()], pa.list_(pa.string())).take(pa.array(of))


def _batch_groups(batch: pa.RecordBatch, config: PairConfig) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array, pa.Array]:
    """(row, g, e1, e2, codes) of the groups of a batch of rows."""
    groups, *columns = (batch.column(batch.schema.get_field_index(c)) for c in ("groups", "w1", "p1", "w2", "p2"))
    counts, each = _nested(groups)
    of_group, kept = np.repeat(np.arange(len(counts)), counts), np.ones(len(each), bool)
    sides = []
    for k, (name, negators) in enumerate((("src", config.negators1), ("trg", config.negators2))):
        (sizes, words), (_, pos) = _nested(columns[2 * k]), _nested(columns[2 * k + 1])
        n, at = _nested(each.field(name))
        group = np.repeat(np.arange(len(each)), n)
        member = (np.cumsum(sizes) - sizes)[of_group[group]] + at.to_numpy(zero_copy_only=False)
        ignored = _ignored(words, pos if config.be_verb and not k else None, np.repeat(np.arange(len(sizes)), sizes), negators)
        kept[group[ignored[member]]] = False
        sides.append((words, pos, group, member, at))
    number, n, parts, contents = np.cumsum(kept) - 1, int(kept.sum()), [], []
    first = np.full(len(each), -1)
    for (words, pos, group, member, at), joiner in zip(sides, (config.joiner1, config.joiner2), strict=True):
        here = kept[group]
        elements, content = _elements(words, pos, member[here], number[group[here]], n, joiner)
        parts.append(elements)
        contents.append((number[group[here]][content], pos.take(pa.array(member[here][content]))))
    one = sides[0][2]
    heads = np.flatnonzero(np.r_[True, one[1:] != one[:-1]]) if len(one) else np.zeros(0, np.int64)
    first[one[heads]] = sides[0][4].to_numpy(zero_copy_only=False)[heads]
    return of_group[kept], pa.array(first[kept].astype(np.int32)), *parts, _codes_shared(contents, n)


def aligned_groups(rows: DataFrame, config: PairConfig) -> DataFrame:
    """row_pos, g (first position of side 1), e1, e2, codes: the groups of each sentence pair as elements.

    rows: row_pos, w1, p1, w2, p2 (words and codes), groups. What negated, be_before_verb, collapsed and head_codes say of one row is made for a batch of rows at once.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, *columns = _batch_groups(batch, config)
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("row_pos")).take(pa.array(row)), *columns], names=["row_pos", "g", "e1", "e2", "codes"])

    kind = rows.schema["row_pos"].dataType.simpleString()
    return rows.select("row_pos", "w1", "p1", "w2", "p2", "groups").mapInArrow(in_steps(lambda: [step]), f"row_pos {kind}, g int, e1 {ELEMENTS}, e2 {ELEMENTS}, codes array<string>")


PHRASES = "array<struct<g:int,codes:array<string>,c1:array<string>,c2:array<string>>>"
PAIRS = "array<struct<w1:string,w2:string>>"


def phrase_step(config: PairConfig):
    """Of a batch of rows with links and groups: row_pos, w1, p1, pairs (the linked words) and phrases, the groups that have codes with the candidates of both sides;
    phrases is null where the words of a side are."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        row, g, e1, e2, codes = _batch_groups(batch, config)
        usable = np.flatnonzero(pc.list_value_length(codes).to_numpy(zero_copy_only=False) > 0)
        take = pa.array(usable)
        sides = [_phrases(e.take(take), joiner, config.max_phrase, once=True) for e, joiner in ((e1, config.joiner1), (e2, config.joiner2))]
        phrases = _lists(row[usable], pa.StructArray.from_arrays([g.take(take), codes.take(take), *sides], names=["g", "codes", "c1", "c2"]), batch.num_rows)
        if column("w1").null_count or column("w2").null_count:
            phrases = pc.if_else(pc.and_(pc.is_valid(column("w1")), pc.is_valid(column("w2"))), phrases, None)
        n, links = _nested(column("links"))
        of, words = np.repeat(np.arange(len(n)), n), []
        for name, place in (("w1", "i"), ("w2", "j")):
            sizes, each = _nested(column(name))
            words.append(each.take(pa.array((np.cumsum(sizes) - sizes)[of] + links.field(place).to_numpy(zero_copy_only=False))))
        pairs = _lists(of, pa.StructArray.from_arrays(words, names=["w1", "w2"]), batch.num_rows)
        return pa.RecordBatch.from_arrays([*map(column, ("row_pos", "w1", "p1")), pairs, phrases], names=["row_pos", "w1", "p1", "pairs", "phrases"])

    return step


#: Elements up to which the choices of a number of them are kept.
CHOICES_KEPT = 32


@lru_cache(1 << 12)
def _choices(n: int, head: int, most: int) -> tuple[tuple[int, ...], ...]:
    """The places that phrase_candidates chooses of n elements."""
    others = [k for k in range(n) if k != head]
    by_length = [sorted(tuple(sorted((*some, head))) for some in combinations(others, size)) for size in (2, 1, 0)]
    return tuple(x for some in by_length[3 - min(3, max(1, most)) :] for x in some)


def _first_choices(words: list[str], head: int, most: int) -> list[tuple[int, ...]]:
    """Of _choices, in order, those whose words no choice before has at the same sides of the head: of equal words at one side the first that can be taken."""
    n, places = len(words), {}
    for k in range(n):
        if k != head:
            places.setdefault((words[k], k > head), []).append(k)
    if len(places) == n - 1:
        return _choices(n, head, most) if n <= CHOICES_KEPT else _choices.__wrapped__(n, head, most)
    later = ((at[0], next_, bisect_right(next_, at[0])) for at in places.values() for next_ in places.values())
    by_length = [[(x, some[k], head) for x, some, k in later if k < len(some)], [(at[0], head) for at in places.values()], [(head,)]]
    return [x for some in by_length[3 - min(3, max(1, most)) :] for x in sorted(tuple(sorted(c)) for c in some)]


def _phrases(elements: pa.Array, joiner: str, most: int, once: bool = False) -> pa.Array:
    """The phrases of phrase_candidates for each of the elements' rows. once: where words repeat, without choices of the same words as one before, which find nothing that it does not."""
    n, each = _nested(elements)
    word, first = pc.fill_null(each.field("word"), ""), np.cumsum(n) - n
    content = pc.fill_null(pc.not_equal(each.field("pos"), ""), False).to_numpy(zero_copy_only=False)
    row, head = np.repeat(np.arange(len(n)), n), np.full(len(n), -1)
    head[row[content]] = np.flatnonzero(content) - first[row[content]]
    # most sides are one word; only of the others are choices made
    several = np.flatnonzero((n > 1) & (head >= 0))
    words = each.field("word").take(pa.array(np.flatnonzero(np.isin(row, several)))).to_pylist()
    counts, made, at = ((n == 1) & (head >= 0)).astype(np.int64), [], 0
    for r, size, h in zip(several.tolist(), n[several].tolist(), head[several].tolist(), strict=True):
        some = words[at : at + size]
        at += size
        found = [joiner.join([some[k] for k in idx if some[k] is not None]) for idx in (_first_choices(some, h, most) if once else _choices(size, h, most))]
        counts[r] = len(found)
        made += found
    of = np.repeat(np.arange(len(n)), counts)
    single = n[of] == 1
    place = np.where(single, first[of], 0)
    place[~single] = len(word) + np.arange(len(made))
    return _lists(of, pa.concat_arrays([word.cast(pa.string()), pa.array(made, pa.string())]).take(pa.array(place)), len(n))


def with_phrases(groups: DataFrame, config: PairConfig) -> DataFrame:
    """row_pos, g, codes, c1, c2: the groups (as aligned_groups gives them) that have codes, with the candidates of both sides."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        *columns, e1, e2 = (batch.column(batch.schema.get_field_index(c)) for c in ("row_pos", "g", "codes", "e1", "e2"))
        return pa.RecordBatch.from_arrays([*columns, _phrases(e1, config.joiner1, config.max_phrase), _phrases(e2, config.joiner2, config.max_phrase)], names=["row_pos", "g", "codes", "c1", "c2"])

    kind = groups.schema["row_pos"].dataType.simpleString()
    return groups.where(F.size("codes") > 0).mapInArrow(in_steps(lambda: [step]), f"row_pos {kind}, g int, codes array<string>, c1 array<string>, c2 array<string>")


def group_candidates(groups: DataFrame, config: PairConfig, norm, analyse=(None, None)) -> DataFrame:
    """The candidates of both sides as longest_match takes them; norm(phrase, pos, side) gives the listed form. groups: as aligned_groups or with_phrases gives them.

    analyse: for each side, what is made of a phrase once, by any column function, before norm(phrase, pos, side, analysis) looks at it under each code.
    """
    usable = groups.where(F.size("codes") > 0)

    def side(k: int, joiner: str) -> DataFrame:
        phrases = F.col(f"c{k}") if f"c{k}" in groups.columns else F.transform(phrase_candidates(F.col(f"e{k}"), joiner, config.max_phrase), lambda c: c["phrase"])
        each = usable.select("row_pos", "g", F.lit(k).alias("side"), "codes", F.posexplode(phrases).alias("place", "phrase"))
        if analyse[k - 1] is not None:
            each = each.withColumn("a", analyse[k - 1](F.col("phrase")))
        more = [] if analyse[k - 1] is None else [F.col("a")]
        norms = F.transform("codes", lambda p: F.struct(p.alias("pos"), norm(F.col("phrase"), p, k, *more).alias("norm")))
        return each.select("row_pos", "g", "side", "place", "phrase", norms.alias("norms"))

    return side(1, config.joiner1).unionByName(side(2, config.joiner2))


def list_at_hand(listed: DataFrame, columns: tuple[str, str, str], most_bytes: int = LIST_BYTES):
    """(hashes of pos and word in order, keys "pos tab word", values, hashes of pos and value) of a list of unique (pos, word), for every task; None if it is large as a stored table or not unique.

    As the hashes are in order, a batch looks its words up in time that follows the batch, not the list; the keys say whether what was found is the word itself.
    """
    pos, word, value = columns
    listed = listed if hasattr(listed, "stored_at") else stored(listed, "list")
    if stored_bytes(listed) > most_bytes:
        return None
    known = listed.where(F.col(pos).isNotNull() & F.col(word).isNotNull())
    found = known.select(F.xxhash64(pos, word).alias("hash"), F.concat_ws("\t", pos, word).alias("key"), F.col(value).alias("value"), F.xxhash64(pos, value).alias("next")).toArrow().sort_by("hash")
    hashes = found.column("hash").to_numpy()
    if (hashes[1:] == hashes[:-1]).any():
        return None
    keys, values = (found.column(c).combine_chunks() for c in ("key", "value"))
    return listed.sparkSession.sparkContext.broadcast((hashes, keys, values, found.column("next").to_numpy()))


def _places(listed, pos: pa.Array, word: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """The places of words in a list at hand, -1 where they are not listed."""
    known, keys, *_ = listed
    if not len(known) or not len(hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = np.flatnonzero(known[at] == hashes)
    take = pa.array(hit)
    same = pc.fill_null(pc.equal(keys.take(pa.array(at[hit])), pc.binary_join_element_wise(pos.take(take), word.take(take), "\t")), False).to_numpy(zero_copy_only=False)
    out = np.full(len(hashes), -1)
    out[hit[same]] = at[hit[same]]
    return out


def _nested(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Sizes of a list column's rows and its values; null rows are empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, column.flatten()


def _first_listed(phrases: pa.Array, codes: pa.Array, norms: pa.Array, listed, overrides) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array, pa.Array]:
    """(row, phrase, pos, norm, id) of each hit of the first phrase of a row that is listed under any of its codes. phrases: longest first; norms: for each phrase the form under each code,
    its hash, and with overrides the phrase's."""
    n, phrase = _nested(phrases)
    m, code = _nested(codes)
    # a form for each phrase and code, as many for each phrase of a row as the row has codes
    each = _nested(_nested(norms)[1])[1]
    form, hashes = each.field("form"), each.field("hash").to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(n)), n)
    width = m[row]
    of = np.repeat(np.arange(len(phrase)), width)
    within = np.arange(len(of)) - np.repeat(np.cumsum(width) - width, width)
    pos = code.take(pa.array((np.cumsum(m) - m)[row[of]] + within))
    if overrides is not None:
        over = _places(overrides, pos, phrase.take(pa.array(of)), each.field("own").to_numpy(zero_copy_only=False))
        there = over >= 0
        value = overrides[2].take(pa.array(over, mask=~there))
        hashes = np.where(there & np.asarray(value.is_valid()), overrides[3][over] if len(overrides[3]) else 0, hashes)
        form = pc.coalesce(value, form)
    at = _places(listed, pos, form, hashes)
    hit = np.flatnonzero(at >= 0)
    rows, firsts = np.unique(row[of[hit]], return_index=True)
    best = np.full(len(n), -1)
    best[rows] = of[hit[firsts]]
    hit = hit[of[hit] == best[row[of[hit]]]]
    take = pa.array(hit)
    return row[of[hit]], phrase.take(pa.array(of[hit])), pos.take(take), form.take(take), listed[2].take(pa.array(at[hit]))


FACTS = "row_pos bigint, g int, pos string, id1 bigint, word1 string, norm1 string, id2 bigint, word2 string, norm2 string"


def facts_in_place(groups: DataFrame, config: PairConfig, norm, listed: tuple, overrides: tuple) -> DataFrame:
    """What longest_match and emit_facts make of groups, with lists at hand (list_at_hand): each group's row gives its facts; no candidate is a row, and nothing is shuffled."""
    rows = groups if "c1" in groups.columns else with_phrases(groups, config)

    def forms(k: int) -> Column:
        own = lambda c, p: [F.xxhash64(p, c).alias("own")] if overrides[k - 1] is not None else []
        named = lambda c, p, form: F.struct(form.alias("form"), F.xxhash64(p, form).alias("hash"), *own(c, p))
        # a form is made once and then looked at by name
        made = F.transform(f"c{k}", lambda c: F.transform("codes", lambda p: F.struct(c.alias("c"), p.alias("p"), norm(c, p, k).alias("f"))))
        return F.transform(made, lambda x: F.transform(x, lambda y: named(y["c"], y["p"], y["f"]))).alias(f"n{k}")

    norms = [forms(1), forms(2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_pos, g, codes, c1, c2, n1, n2 = (batch.column(batch.schema.get_field_index(c)) for c in ("row_pos", "g", "codes", "c1", "c2", "n1", "n2"))
            sides = [_first_listed(c, codes, n, a.value, o and o.value) for c, n, a, o in ((c1, n1, listed[0], overrides[0]), (c2, n2, listed[1], overrides[1]))]
            # a row's hits of both sides under one code
            one, two = ({key: i for i, key in enumerate(zip(side[0].tolist(), side[2].to_pylist(), strict=True))} for side in sides)
            pairs = [(i, two[key]) for key, i in one.items() if key in two]
            at = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
            of = pa.array(sides[0][0]).take(at[0])
            words = [[side[i].take(a) for i in (4, 1, 3)] for side, a in zip(sides, at, strict=True)]
            yield pa.RecordBatch.from_arrays([row_pos.take(of), g.take(of), sides[0][2].take(at[0]), *words[0], *words[1]], names=["row_pos", "g", "pos", "id1", "word1", "norm1", "id2", "word2", "norm2"])

    return rows.select("*", *norms).mapInArrow(run, FACTS)


def align_pipeline(rows: DataFrame, config: PairConfig, listed1: DataFrame, listed2: DataFrame, exceptions: DataFrame, norm, overrides=(None, None), analyse=(None, None)) -> DataFrame:
    """Facts of sentence pairs with links: the composition of the operators above. overrides: a table for each side, or None; analyse as in group_candidates."""
    # stored: each step is planned over columns instead of nested expressions
    return group_facts(stored(aligned_groups(rows, config), "groups"), config, listed1, listed2, exceptions, norm, overrides, analyse)


def group_facts(groups: DataFrame, config: PairConfig, listed1: DataFrame, listed2: DataFrame, exceptions: DataFrame, norm, overrides=(None, None), analyse=(None, None)) -> DataFrame:
    """Facts of groups, as aligned_groups or with_phrases gives them; the rest as in align_pipeline."""
    if analyse == (None, None):
        at_hand = [list_at_hand(x, ("pos", "word", "id")) for x in ((listed1,) if listed2 is listed1 else (listed1, listed2))]
        over = [None if x is None else list_at_hand(x, ("pos", "surface", "normalized")) for x in overrides]
        if None not in at_hand and all((x is None) == (y is None) for x, y in zip(over, overrides, strict=True)):
            return antonym_filter(facts_in_place(groups, config, norm, (at_hand[0], at_hand[-1]), tuple(over)), exceptions)
    candidates = stored(group_candidates(groups, config, norm, analyse), "candidates")
    one = longest_match(candidates.where("side = 1"), listed1, overrides[0])
    two = longest_match(candidates.where("side = 2"), listed2, overrides[1])
    return antonym_filter(emit_facts(one.unionByName(two)), exceptions)


def align_unlisted(rows: DataFrame, config: PairConfig) -> DataFrame:
    """Without word lists every candidate matches, so the longest wins: row_pos, g, pos, word1, word2 with ids of -1."""
    groups = aligned_groups(rows, config).where(F.size("codes") > 0)
    best = lambda k, joiner: F.element_at(phrase_candidates(F.col(f"e{k}"), joiner), 1)["phrase"]
    facts = groups.select("row_pos", "g", F.explode("codes").alias("pos"), best(1, config.joiner1).alias("word1"), best(2, config.joiner2).alias("word2"))
    return facts.withColumn("id1", F.lit(-1).cast("long")).withColumn("id2", F.lit(-1).cast("long"))
