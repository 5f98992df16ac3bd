r"""Near-duplicates by a signature-coordinate inverted join.

A document is the set of its 5-word shingles (A-Z as a-z), as 64-bit hashes. Equal sets are one class.
Each class has a signature of `COORDINATES` MinHash values and is posted under the pairs (coordinate, value) of the
first of them, the prefix. A posting list of up to `SHORT` classes is gathered whole. Longer lists are skipped in that
merge and split by the values of `REFINED` more coordinates, which each posted coordinate has for itself. So two classes of similarity s
are together in the list of one coordinate with a chance of s (1 - (1 - s) ** REFINED) at least, and the lists miss them independently.
Within a list, collisions are counted over whole signatures, of which one bit a coordinate is kept: a
pair stays up to `apart` bits of difference, unless it has met in an earlier list. `fitted` derives the length of the prefix and `apart` from the
least similarity, so that of links at just that similarity all lists together miss `LOST` at most, even if all are long, and the count `OVER` at most.
Of what stays in a list a shortest spanning forest is confirmed first, on the full sets, by integer arithmetic. Where all its
edges are links, every pair of the list is connected. The lists that have an edge that is none are looked at once more,
for all pairs that are not connected yet. So a large group of copies costs its size, and no link between components is lost.

A split list beyond `BLOCK` classes is cut into blocks, and each pair of blocks is a group of bounded size. Exact copies,
however many, are one posting. The texts that confirmation needs are fetched through a bitmap of their hashes before anything is shuffled.

Rows. Null texts and texts without words have no shingles and link with nothing, not with each other either. A null doc_id takes part;
a component's id is its least id that is not null, and a component without one keeps all its rows. Rows that repeat an id are rows of their own, each with its own text.
Very long texts are processed whole. An empty table gives no rows. Other columns pass through `keep_one`.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.common import bitmap, in_bitmap, materialise, read_table, releasing, short_batches, small_batches, text_or_empty, unused, values_bytes
from glossweave.llm.components import components
from glossweave.llm.words import HASH_BYTES, hashed_words, mix

SHINGLE = 5
COORDINATES = 1024
REFINED = 2
#: The chances that a link at the least similarity is in no list together, and that it differs in more bits than are let through.
LOST = 1e-6
OVER = 4e-6
#: The similarity, as a share of 100, from which documents are linked.
LEAST = 85
SHORT = 64
BLOCK = 2048
SKETCH = "doc_id long, th long, set binary, n_shingles long, post array<int>, sig binary"


class Fit(NamedTuple):
    """Posted coordinates, and the bits of difference up to which a pair is confirmed."""

    posted: int
    apart: int

    @property
    def width(self) -> int:
        """Values of a class that its lists need: the posted ones, then those that refine the first, the second, ..."""
        return self.posted * (1 + REFINED)

    def refining(self, at: int) -> slice:
        return slice(self.posted + at * REFINED, self.posted + (at + 1) * REFINED)


def fitted(least: int) -> Fit:
    """What finds links from `least`, a share of 100, with the chances LOST and OVER of missing one."""
    if not 0 < least <= 100:
        raise ValueError("the least similarity is a share of 100")
    s = least / 100
    missed = 1 - s * (1 - (1 - s) ** REFINED)
    fit = Fit(max(1, math.ceil(math.log(LOST) / math.log(missed))) if missed > 0 else 1, 0)
    if fit.width > COORDINATES:
        raise ValueError(f"a least similarity of {least} needs more than {COORDINATES} coordinates")
    # a bit differs where the values do, every other time
    q, apart = (1 - s) / 2, 0
    chances = [math.comb(COORDINATES, k) * q**k * (1 - q) ** (COORDINATES - k) for k in range(COORDINATES // 2)] if q else [1.0]
    while math.fsum(chances[apart + 1 :]) > OVER:
        apart += 1
    return fit._replace(apart=apart)


FIT = fitted(LEAST)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (x[:COORDINATES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (x[COORDINATES:] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    h, _, _, firsts = hashed_words(data, offsets, True)
    n = max(0, len(h) - SHINGLE + 1)
    all5 = np.zeros(n, np.uint64)
    weights = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64))
    for k in range(SHINGLE):
        all5 += h[k : k + n] * (weights[k] | np.uint64(1))
    all5 = mix(all5)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(all5[a : b - SHINGLE + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for k in range(a, b):
                whole = mix(np.array([whole ^ h[k]]))[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The least value of each coordinate; held is a small array to work in."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), len(held)):
        part = x[i : i + len(held), None]
        values = np.multiply(part, a, out=held[: len(part)])
        values += b
        np.minimum(out, values.min(0), out=out)
    return out


def one_bit(values: np.ndarray) -> bytes:
    return np.packbits((values * np.uint32(0x9E3779B1)) >> np.uint32(31)).tobytes()


def _sketch(width: int):
    def run(batches):
        import xxhash

        a, b = _coefficients()
        held = np.empty((64, COORDINATES), np.uint32)
        for batch in small_batches(batches, most=HASH_BYTES):
            sets = shingle_sets(*values_bytes(batch.column("text")))
            sigs = [signature(s, a, b, held) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("th"),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[:width].view(np.int32) for s in sigs], pa.list_(pa.int32())),
                    pa.array([one_bit(s) for s in sigs], pa.binary()),
                ],
                names=["doc_id", "th", "set", "n_shingles", "post", "sig"],
            )

    return run


def _collisions(left, right, at: int, by: int | None, same: bool, fit: Fit = FIT):
    """Index pairs that differ in fit.apart bits at most and have not met before.

    They have met if they share an earlier coordinate and some that refines it: split or not, its list brought them
    together. by: the refining coordinate of this list, if it is split.
    """
    (post_l, sig_l), (post_r, sig_r) = left, right
    out = [np.zeros((0, 3), np.int64)]
    for i in range(0, len(sig_l), 64):
        p, q = post_l[i : i + 64, None], post_r[None]
        near = np.zeros((p.shape[0], q.shape[1]), np.uint16)
        for k in range(sig_l.shape[1]):
            near += np.bitwise_count(sig_l[i : i + 64, None, k] ^ sig_r[None, :, k])
        x, y = np.nonzero(near <= fit.apart)
        if same:
            x, y = x[y > i + x], y[y > i + x]
        p, q = post_l[i + x], post_r[y]
        same_values, met = p == q, np.zeros(len(p), bool)
        for k in range(at):
            met |= same_values[:, k] & same_values[:, fit.refining(k)].any(1)
        if by is not None:
            met |= same_values[:, fit.refining(at)][:, :by].any(1)
        out.append(np.column_stack([i + x[~met], y[~met], near[x, y][~met]]))
    return np.concatenate(out)


def _forest(pairs: np.ndarray, n: int, second: int) -> list[tuple[int, int]]:
    """A shortest spanning forest of (x, y, distance); second: what is added to y, so that sides differ."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in pairs[np.argsort(pairs[:, 2], kind="stable"), :2].tolist():
        a, b = find(x), find(y + second)
        if a != b:
            root[a] = b
            out.append((x, y))
    return out


def _chosen(left, right, at: int, by: int | None, same: bool, labels, fit: Fit = FIT) -> list[tuple[int, int]]:
    """First a forest of the pairs; with labels (of left, of right), the pairs whose labels differ."""
    pairs = _collisions(left, right, at, by, same, fit)
    if labels is None:
        n = len(left[1])
        return _forest(pairs, n if same else n + len(right[1]), 0 if same else n)
    return [(x, y) for x, y in pairs[:, :2].tolist() if labels[0][x] != labels[1][y]]


def _parts(posts, sigs, fit: Fit):
    return np.array(posts, np.int32).reshape(-1, fit.width), np.frombuffer(b"".join(sigs), np.uint64).reshape(-1, COORDINATES // 64)


def _pairs_batch(pairs, key: dict) -> pa.RecordBatch:
    kinds = {"at": pa.int32(), "value": pa.int32(), "by": pa.int32(), "more": pa.int32(), "i": pa.int32(), "j": pa.int32()}
    held = [pa.array([key.get(k)] * len(pairs), t) for k, t in kinds.items()]
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary()), *held], names=["u", "v", *kinds])


PAIRS = "u binary, v binary, at int, value int, by int, more int, i int, j int"


def _short_lists(labelled: bool, fit: Fit):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                members = row["members"]
                side, names = _parts([m["post"] for m in members], [m["sig"] for m in members], fit), [m["set"] for m in members]
                labels = [m["root"] for m in members]
                found = _chosen(side, side, row["at"], None, True, (labels, labels) if labelled else None, fit)
                if found:
                    yield _pairs_batch([(names[x], names[y]) for x, y in found], {"at": row["at"], "value": row["value"]})

    return run


def _block_pairs(labelled: bool, fit: Fit):
    def run(table: pa.Table) -> pa.Table:
        key = {n: table.column(n)[0].as_py() for n in ("at", "value", "by", "more", "i", "j")}
        sides, block = [], table.column("b").to_numpy()
        for b in sorted({key["i"], key["j"]}):
            part = table.filter(pa.array(block == b))
            sides.append((part.column("set").to_pylist(), _parts(part.column("post").to_pylist(), part.column("sig").to_pylist(), fit), part.column("root").to_pylist()))
        (u, left, roots_l), (v, right, roots_r) = sides[0], sides[-1]
        found = _chosen(left, right, key["at"], key["by"], key["i"] == key["j"], (roots_l, roots_r) if labelled else None, fit) if u and v else []
        return pa.Table.from_batches([_pairs_batch([(u[x], v[y]) for x, y in found], key)])

    return run


class Lists:
    """The posting lists of classes (set, post, sig)."""

    KEY, PART = ["at", "value"], ["at", "value", "by", "more", "i", "j"]

    def __init__(self, classes: DataFrame, fit: Fit):
        self.classes, self.fit = classes, fit
        self.every = classes.select("set", F.posexplode(F.slice("post", 1, fit.posted)).alias("at", "value"))
        self.sizes = materialise(self.every.groupBy(*self.KEY).agg(F.count("*").alias("n")).where("n > 1"), "neardup-lists")
        # a long list is split by each coordinate that refines it; the rows go without signatures until the parts are known
        posted = [F.struct(F.col("post")[k].alias("value"), F.slice("post", fit.refining(k).start + 1, REFINED).alias("fine")) for k in range(fit.posted)]
        split = classes.select("set", F.posexplode(F.array(*posted)).alias("at", "of")).select("set", "at", "of.value", "of.fine")
        split = split.join(self.sizes.where(F.col("n") > SHORT).drop("n"), self.KEY).select("set", "at", "value", F.posexplode("fine").alias("by", "more"))
        split = materialise(split, "neardup-split")
        parts = split.groupBy("at", "value", "by", "more").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        long = split.join(parts, ["at", "value", "by", "more"]).withColumn("b", F.pmod(F.xxhash64("set", "at"), F.col("blocks")).cast("int"))
        long = long.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        self.long = long.select("set", "at", "value", "by", "more", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), "b")

    def pairs(self, roots: DataFrame | None = None, again: DataFrame | None = None) -> DataFrame:
        """Pairs with their list: forests of all lists, or, of the lists in `again`, the pairs that roots (set, root) part."""
        short = self.every.join(self.sizes.where(F.col("n") <= SHORT).drop("n"), self.KEY)
        long, rows = self.long, self.classes.withColumn("root", F.col("set"))
        if roots is not None:
            short = short.join(again.where("i IS NULL").select(*self.KEY).distinct(), self.KEY, "left_semi")
            long = long.join(again.where("i IS NOT NULL").select(*self.PART).distinct(), self.PART, "left_semi")
            rows = self.classes.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
        whole = short.join(rows, "set").groupBy(*self.KEY).agg(F.collect_list(F.struct("set", "post", "sig", "root")).alias("members"))
        found = whole.mapInArrow(releasing(_short_lists(roots is not None, self.fit)), PAIRS)
        return found.unionByName(long.join(rows, "set").groupBy(*self.PART).applyInArrow(_block_pairs(roots is not None, self.fit), PAIRS))


def _fetch(bits: bytes):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bits, batch.column("th").to_numpy())))

    return run


def _sets(batches):
    import xxhash

    for batch in small_batches(batches, most=HASH_BYTES):
        sets = [s.tobytes() for s in shingle_sets(*values_bytes(batch.column("text")))]
        yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())], names=["set", "shingles"])


def _confirmed(least: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("su"), batch.column("sv"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= least * (len(x) + len(y) - both))
            batch = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"])

    return run


def confirm(pairs: DataFrame, owners: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """The pairs that are similar on their full sets. owners: set, th of a row that has it; texts: th, text."""
    needed = pairs.select(F.col("u").alias("set")).union(pairs.select("v")).distinct().join(owners, "set").select("th")
    needed = materialise(needed.distinct(), "neardup-needed")
    few = texts.mapInArrow(releasing(_fetch(bitmap(needed, "th"))), "th long, text string")
    fetched = few.join(needed, "th", "left_semi").dropDuplicates(["th"]).select("text").mapInArrow(releasing(_sets), "set binary, shingles binary")
    sets = materialise(fetched.dropDuplicates(["set"]), "neardup-sets")
    left = pairs.join(sets.withColumnRenamed("shingles", "su"), F.col("u") == F.col("set")).drop("set")
    both = left.join(sets.withColumnRenamed("shingles", "sv"), F.col("v") == F.col("set")).drop("set")
    return both.select("u", "v", "su", "sv").mapInArrow(releasing(_confirmed(least)), "u binary, v binary")


def near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, component_id, kept: one row for each row of docs."""
    fit = fitted(least)
    short_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("th", F.xxhash64("text"))
    sketches = materialise(texts.mapInArrow(releasing(_sketch(fit.width)), SKETCH), "neardup-sketches")
    full = sketches.where("n_shingles > 0")
    classes = full.groupBy("set").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("rows"), F.min("th").alias("th"), F.first("post").alias("post"), F.first("sig").alias("sig"))
    classes = materialise(classes, "neardup-classes")
    owners, fetch = classes.select("set", "th"), texts.select("th", "text")
    lists = Lists(classes.select("set", "post", "sig"), fit)
    forests = materialise(lists.pairs(), "neardup-forests")
    links = materialise(confirm(forests.select("u", "v").distinct(), owners, fetch, least), "neardup-links")
    failed = materialise(forests.join(links, ["u", "v"], "left_anti"), "neardup-failed")
    roots = components(links).withColumnRenamed("node", "set")
    parted = materialise(lists.pairs(roots, failed).select("u", "v").distinct().join(failed.select("u", "v"), ["u", "v"], "left_anti"), "neardup-parted")
    if not parted.isEmpty():
        more = materialise(confirm(parted, owners, fetch, least), "neardup-more")
        if not more.isEmpty():
            roots = components(links.unionByName(more)).withColumnRenamed("node", "set")
    of_class = classes.select("set", "least_id", "rows").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    least_ids = of_class.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n"), F.sum("rows").alias("rows"))
    # classes of one row that link with nothing need no join
    joined = of_class.select("set", "root").join(least_ids.where("n > 1 OR rows > 1"), "root").select(F.col("set").alias("_set"), "component_id", F.lit(True).alias("_linked"))
    out = sketches.select("doc_id", "th", "set", "n_shingles").join(joined, (F.col("set") == F.col("_set")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("_linked"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "th", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row of each group of near_duplicates, with the columns of docs; of repeated rows one stays as well."""
    id_, th, key, hash_, row = unused(docs, "id", "th", "key", "hash", "row")
    kept = near_duplicates(docs, least).where("kept").select(F.col("doc_id").alias(id_), F.col("th").alias(th)).distinct()
    left = docs.withColumn(key, F.col("doc_id").cast("long")).withColumn(hash_, F.xxhash64(text_or_empty()))
    joined = left.join(kept, F.col(key).eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(th)), "left_semi")
    # dealt and sorted by these two already
    place = F.row_number().over(Window.partitionBy(key, hash_).orderBy(hash_))
    return joined.withColumn(row, place).where(F.col(row) == 1).select(*docs.columns)


def op2_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
