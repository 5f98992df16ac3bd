"""Language-model scores by a hierarchical Pitman-Yor model whose seating is drawn by Gibbs sampling.

Every token sits in the restaurant of its context, the word before it. A word that makes up at least one in 2^17 of all training tokens has a restaurant of
its own as a context; rarer words share one for each pair of last bytes, as words that end alike are followed alike, and the begin of a text has its own.
All of them share the root restaurant as parent, and the root's base is uniform over the known words and one unknown. In restaurant u a word w has c customers
at t tables; each table is a customer of the parent, and

    P_u(w) = (c - d t + (theta + d T) P_parent(w)) / (theta + C),    T and C the tables and customers of u.

Gibbs sampling draws the seating of a word in a restaurant anew, given all else: t has the weight S_d(c, t) P_parent(w)^t prod_{j < t} (theta + d (T' + j)), where S_d
counts the ways to sit and T' are the tables of the other words. A round draws all seatings at once from the state after the round before; a word of more than
`EXACT` customers in a restaurant gets its likeliest number of tables, rounded at random, so that what a cell costs is bounded. The discounts come from the
numbers of cells with one and two customers. After `BURNED` rounds, the predictive probabilities of the states are averaged; a text's score
is the sum of their logarithms.

On Spark: one group-by counts words, and the words that have restaurants are few by definition at any size. One scan deals the corpus's distinct (context, word) cells
of each block of texts, packed, to buckets by a hash of the word, or of word and context where the word is one of those few: so a
rare word's cells meet in one bucket, which then knows its customers in the root, and a frequent one's spread over all. A packed row holds a cell at least, so there are
never more rows than a row for each cell would make. A bucket's cells are one row of a stored table; a round is a scan of it that gives the tables of each restaurant and of each
frequent word, summed by Spark to the few numbers that the next round needs. A draw depends on the cell, the round and the seed alone, so a
lost task draws the same again and no state is written: a bucket draws the earlier rounds again from the numbers that each had. At last a bucket sends the logarithms of its cells back to
the blocks, whose token sequences lie in files of the shared folder, a new name for each attempt.

Rows. A null text is empty; a text without words is its end token alone. Repeated rows all count and all come back. Null ids train. No training rows leave one unknown
word of probability 1. Kept columns called as an output give way to it. Words are told apart by 64-bit hashes. No rows give none.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from glossweave.llm.common import gathered, materialise, open_shared, packed_batch, read_table, release, releasing, scratch, shared_dir, short_batches, text_or_empty, unpacked_batch, values_bytes
from glossweave.llm.words import hashed_words, mix

#: Hash of the token that ends a text. No word's bytes are as few as none.
END = np.uint64(1)
#: A word with one in so many of all training tokens has a restaurant of its own.
SHARE = 1 << 17
#: Restaurants of rare contexts: by the low six bits of their last two bytes.
ENDINGS = 1 << 12
#: Customers of a word up to which its tables are drawn from their exact distribution.
EXACT = 512
THETA = 1.0
BURNED, KEPT = 1, 2
SEED = 20_111
#: Bytes of text in a block, and for each bucket.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
SENT = "bucket int, block long, words binary, lengths binary, contexts binary, counts binary"
CELLS = "bucket int, words binary, lengths binary, contexts binary, counts binary, blocks binary, sizes binary, places binary"
OUTPUTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
BACK = "block long, bucket int, lengths binary, counts binary, logs binary"


def pack(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers as byte planes, compressed: high planes are mostly zeros."""
    import zstandard

    size = np.dtype(kind).itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, size).T.tobytes())


def unpack(raw: bytes, kind: str = "<u4") -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)), "<u8")


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, "<u8"), dtype=np.uint64)


@dataclass
class Round:
    """What a round leaves for the next: tables of each restaurant, the root's customers and tables, and the root's probability of each frequent word."""

    tables: np.ndarray
    root_customers: int
    root_tables: int
    frequent: np.ndarray


@dataclass
class Model:
    """frequent: sorted hashes of the words with restaurants of their own, and counts, their training tokens. Restaurants are numbered:
    frequent words, the begin, endings."""

    tokens: int
    known: int
    frequent: np.ndarray
    counts: np.ndarray
    customers: np.ndarray | None = None
    discounts: tuple[float, float] = (0.5, 0.5)
    rounds: list[Round] = field(default_factory=list)

    @property
    def restaurants(self) -> int:
        return len(self.frequent) + 1 + ENDINGS

    def of(self, words: np.ndarray) -> np.ndarray:
        """The number of each frequent word, -1 for others."""
        if not len(self.frequent):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return np.where(self.frequent[at] == words, at, -1)

    def root(self, customers, tables, state: Round):
        """The root's probability of words with so many customers and tables."""
        d = self.discounts[0]
        return (customers - d * tables + (THETA + d * state.root_tables) / (self.known + 1)) / (THETA + state.root_customers)


def uniform(keys: np.ndarray, *numbers: int) -> np.ndarray:
    """A number in (0, 1) for each key, another for other numbers."""
    for n in numbers:
        keys = mix(keys ^ np.uint64(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return ((keys >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


_WAYS: dict[float, np.ndarray] = {}


def log_ways(d: float) -> np.ndarray:
    """log S_d(c, t) for c and t up to EXACT: the ways to seat c customers at t tables, with their weights."""
    if d not in _WAYS:
        ways = np.full((EXACT + 1, EXACT + 1), -np.inf)
        ways[1, 1] = 0.0
        for c in range(1, EXACT):
            t = np.arange(1, c + 1)
            ways[c + 1, 1 : c + 1] = ways[c, 1 : c + 1] + np.log(c - d * t)
            ways[c + 1, 2 : c + 2] = np.logaddexp(ways[c + 1, 2 : c + 2], ways[c, 1 : c + 1])
        _WAYS[d] = ways
    return _WAYS[d]


def draw_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, keys: np.ndarray, number: int) -> np.ndarray:
    """Tables of words with c customers each, in restaurants with so many tables of other words, p the parent's probability."""
    t = np.minimum(c, 1)
    live = np.flatnonzero(c > 1)
    live = live[np.argsort(c[live], kind="stable")]
    n, u = np.minimum(c[live], EXACT), uniform(keys[live], number)
    ways, at = log_ways(d), 0
    while at < len(live):
        # rows of up to half as many customers more go together
        width = min(int(n[at]) + int(n[at]) // 2, EXACT)
        stop = min(int(np.searchsorted(n, width, "right")), at + 1 + (1 << 20) // width)
        some, most = live[at:stop], n[at:stop]
        j = np.arange(int(most[-1]))
        w = ways[most][:, 1 : len(j) + 1] + np.cumsum(np.log(THETA + d * (others[some][:, None] + j)) + np.log(p[some])[:, None], axis=1)
        w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), axis=1)
        t[some] = 1 + (w < (u[at:stop] * w[:, -1])[:, None]).sum(1).clip(max=most - 1)
        at = stop
    many = live[c[live] > EXACT]
    t[many] = np.floor(likely_tables(c[many], others[many], p[many], d) + uniform(keys[many], number, 1)).astype(np.int64).clip(1, c[many])
    return t


def likely_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float) -> np.ndarray:
    """The likeliest number of tables of many customers, from the saddle point of the generating function of S_d, (1 - (1 - x)^d)^t."""
    low, high = np.ones(len(c)), c.astype(np.float64)
    for _ in range(80):
        t = (low + high) / 2
        z = np.minimum(d * t / ((THETA + d * (others + t)) * p), 1 - 1e-15)
        rest = (1 - z) ** (1 / d)
        over = t * d * (1 - rest) * rest ** (d - 1) / z > c
        low, high = np.where(over, low, t), np.where(over, t, high)
    return low


def tokens_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all tokens of the batch's texts, each text's end among them; edges of the texts; the last two bytes of each, as an ending)."""
    data, offsets = values_bytes(batch.column(batch.schema.get_field_index("text")))
    h, starts, ends, firsts = hashed_words(data, offsets, True)
    n = np.diff(firsts)
    edges = np.concatenate([[0], np.cumsum(n + 1)])
    at = np.arange(len(h)) + np.repeat(np.arange(len(n)), n)
    tokens, ending = np.full(edges[-1], END), np.zeros(edges[-1], np.int32)
    tokens[at] = h
    low = lambda x: data[x].astype(np.int32) & 63
    ending[at] = low(ends - 1) * 64 + np.where(ends - starts > 1, low(np.maximum(ends - 2, 0)), 0)
    return tokens, edges, ending


def _word_counts(batches):
    for batch in gathered(batches, "text", BLOCK_BYTES):
        words, n = np.unique(tokens_of(batch)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


def _blocks(model: Model, folder: str, buckets: int):
    """Writes each block's token sequences to a file and sends its cells to their buckets."""

    def run(batches):
        for batch in gathered(batches, "text", BLOCK_BYTES):
            block = uuid.uuid4().int >> 65
            tokens, edges, ending = tokens_of(batch)
            words, first, word = np.unique(tokens, return_index=True, return_inverse=True)
            number = model.of(words)
            own = np.where(number >= 0, number, len(model.frequent) + 1 + ending[first])
            context = np.empty(len(tokens), np.int64)
            context[1:] = own[word[:-1]]
            context[edges[:-1]] = len(model.frequent)
            cells, cell = np.unique(word * model.restaurants + context, return_inverse=True)
            trains = np.repeat(batch.column(batch.schema.get_field_index("trains")).to_numpy(zero_copy_only=False), np.diff(edges))
            n = np.bincount(cell[trains], minlength=len(cells))
            word, context = cells // model.restaurants, cells % model.restaurants
            spread = np.where(number[word] >= 0, mix(words[word] ^ mix(context.astype(np.uint64))), words[word])
            bucket = (mix(spread) % np.uint64(buckets)).astype(np.int64)
            del spread
            order = np.argsort(bucket, kind="stable")  # by word, then context, in each bucket
            place = np.empty(len(cells), np.int64)
            place[order] = np.arange(len(cells))
            kept = batch.drop_columns(["text", "trains"])
            with open_shared(f"{folder}/{block}", True) as sink, pa.ipc.new_file(sink, pa.schema([(x, pa.binary()) for x in ("kept", "edges", "places")])) as out:
                out.write_batch(pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (packed_batch(kept), pack(np.diff(edges)), pack(place[cell]))], names=["kept", "edges", "places"]))
            del tokens, cell, place, trains
            bucket, word, context, n = bucket[order], word[order], context[order], n[order]
            cut = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(order)]
            rows: dict = {x.split()[0]: [] for x in SENT.split(", ")}
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                begin = np.flatnonzero(np.diff(word[a:b], prepend=-1))
                values = int(bucket[a]), block, pack_sorted(words[word[a:b][begin]]), pack(np.diff(np.append(begin, b - a))), pack(context[a:b]), pack(n[a:b])
                for name, value in zip(rows, values, strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *((x, pa.binary()) for x in list(rows)[2:])]))

    return run


def _meet(table: pa.Table) -> pa.Table:
    """One row of a bucket: its distinct cells, with the counts of all blocks, and for each block the places of its cells among them."""
    rows = table.sort_by("block").to_pylist()
    sizes, words, contexts, counts = [], [], [], []
    for r in rows:
        contexts.append(unpack(r["contexts"]))
        words.append(np.repeat(unpack_sorted(r["words"]), unpack(r["lengths"])))
        counts.append(unpack(r["counts"]))
        sizes.append(len(contexts[-1]))
    blocks, bucket = [r["block"] for r in rows], rows[0]["bucket"]
    del rows
    words, contexts, counts = np.concatenate(words), np.concatenate(contexts), np.concatenate(counts)
    order = np.lexsort((contexts, words))
    words, contexts = words[order], contexts[order]
    new = np.r_[True, (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])]
    number = np.cumsum(new) - 1
    place = np.empty(len(order), np.int64)
    place[order] = number
    total = np.bincount(number, weights=counts[order]).astype(np.int64)
    words, contexts = words[new], contexts[new]
    begin = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    edges = np.cumsum([0, *sizes])
    # a block's places ascend, so their steps are small
    steps = np.concatenate([np.diff(place[a:b], prepend=0) for a, b in zip(edges[:-1], edges[1:], strict=True)])
    values = bucket, pack_sorted(words[begin]), pack(np.diff(np.append(begin, len(words)))), pack(contexts), pack(total, "<u8"), pack(np.array(blocks), "<u8"), pack(np.array(sizes)), pack(steps)
    release()
    return pa.Table.from_pydict({x.split()[0]: [v] for x, v in zip(CELLS.split(", "), values, strict=True)}, schema=pa.schema([("bucket", pa.int32()), *((x.split()[0], pa.binary()) for x in CELLS.split(", ")[1:])]))


class Seating:
    """A bucket's cells and their tables, round by round."""

    def __init__(self, model: Model, row: dict):
        self.model = model
        self.words, lengths = unpack_sorted(row["words"]), unpack(row["lengths"])
        self.word = np.repeat(np.arange(len(self.words), dtype=np.int32), lengths)
        self.context, self.c = unpack(row["contexts"]).astype(np.int32), unpack(row["counts"], "<u8").astype(np.int64)
        self.frequent = model.of(self.words)
        self.rare = self.frequent < 0
        self.keys = mix(self.words)[self.word] ^ mix(self.context.astype(np.uint64))
        self.t = np.minimum(self.c, 1)
        self.root_c = self.sums(self.t)
        self.root_t = np.minimum(self.root_c, 1)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Of each word's cells; those of a rare word are all here."""
        return np.bincount(self.word, weights=x, minlength=len(self.words)).astype(np.int64)

    def root(self, state: Round) -> np.ndarray:
        """The root's probability of each word, in the state that the tables are in."""
        p = self.model.root(self.root_c, self.root_t, state)
        p[~self.rare] = state.frequent[self.frequent[~self.rare]]
        return p

    def draw(self, number: int, state: Round) -> None:
        m = self.model
        self.t = draw_tables(self.c, state.tables[self.context] - self.t, self.root(state)[self.word], m.discounts[1], self.keys, number)
        self.root_c = self.sums(self.t)
        base = np.full(len(self.words), 1 / (m.known + 1))
        self.root_t = draw_tables(self.root_c, state.root_tables - self.root_t, base, m.discounts[0], self.words, number)

    def predictive(self, state: Round) -> np.ndarray:
        d, root = self.model.discounts[1], self.root(state)[self.word]
        return (self.c - d * self.t + (THETA + d * state.tables[self.context]) * root) / (THETA + self.model.customers[self.context])


SUMS = "kind int, place int, value long"
TABLES, FREQUENT, ROOT, CUSTOMERS, CELLS_OF, WORDS_OF = range(6)


def _totals(model: Model):
    """What the buckets of a task come to after the rounds so far: (kind, place, value). Without rounds, of the seating that each word begins with, one table."""

    def run(batches):
        begin = not model.rounds
        tables, frequent, root = np.zeros(model.restaurants, np.int64), np.zeros(len(model.frequent), np.int64), np.zeros(2, np.int64)
        customers, cells_of, words_of = np.zeros(model.restaurants, np.int64), np.zeros(3, np.int64), np.zeros(3, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                s = Seating(model, row)
                for number, state in enumerate(model.rounds):
                    s.draw(number + 1, state)
                tables += np.bincount(s.context, weights=s.t, minlength=len(tables)).astype(np.int64)
                frequent += np.bincount(s.frequent[~s.rare], weights=s.root_c[~s.rare], minlength=len(frequent)).astype(np.int64)
                root += np.array([s.root_c[s.rare].sum(), s.root_t[s.rare].sum()])
                if begin:
                    customers += np.bincount(s.context, weights=s.c, minlength=len(tables)).astype(np.int64)
                    cells_of += np.bincount(s.c[s.c < 3], minlength=3)
                    words_of += np.bincount(s.root_c[s.rare & (s.root_c < 3)], minlength=3)
                del s
                release()
        for kind, values in ((TABLES, tables), (FREQUENT, frequent), (ROOT, root), (CUSTOMERS, customers), (CELLS_OF, cells_of), (WORDS_OF, words_of)):
            at = np.flatnonzero(values)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(values[at])], names=["kind", "place", "value"])

    return run


def _answers(model: Model, burned: int):
    """The logarithms of each block's cells, and the training tokens of their words."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                s = Seating(model, row)
                p = np.zeros(len(s.c))
                for number, state in enumerate(model.rounds[:-1]):
                    s.draw(number + 1, state)
                    if number + 1 > burned:
                        p += s.predictive(model.rounds[number + 1])
                logs = np.log10(p / (len(model.rounds) - 1 - burned)).astype("<f4")
                count = s.sums(s.c)
                count[~s.rare] = model.counts[s.frequent[~s.rare]]
                word = s.word
                del s, p
                blocks, sizes, steps = unpack(row["blocks"], "<u8").astype(np.int64), unpack(row["sizes"]), unpack(row["places"])
                edges = np.cumsum(np.concatenate([[0], sizes.astype(np.int64)])).tolist()
                out: dict = {"lengths": [], "counts": [], "logs": []}
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    at = np.cumsum(steps[a:b].astype(np.int64))
                    begin = np.flatnonzero(np.diff(word[at], prepend=-1))
                    out["lengths"].append(pack(np.diff(np.append(begin, len(at)))))
                    out["counts"].append(pack(count[word[at[begin]]], "<u8"))
                    out["logs"].append(pack(logs[at], "<f4"))
                columns = [pa.array(blocks), pa.array([row["bucket"]] * len(blocks), pa.int32()), *(pa.array(x, pa.binary()) for x in out.values())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", *out])
                release()

    return run


def _assemble(model: Model, folder: str, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("bucket").to_pylist()
        logs = np.concatenate([unpack(r["logs"], "<f4") for r in rows]).astype(np.float64)
        count = np.concatenate([np.repeat(unpack(r["counts"], "<u8"), unpack(r["lengths"])) for r in rows])
        with open_shared(f"{folder}/{rows[0]['block']}") as source:
            kept, edges, places = (c[0].as_py() for c in pa.ipc.open_file(source).get_batch(0).columns)
        kept, at = unpacked_batch(kept), unpack(places)
        n = unpack(edges).astype(np.int64)
        first = np.cumsum(n) - n
        base = np.log10((count + 1.0) / (model.tokens + model.known + 1.0))
        total = lambda x: pa.array(np.add.reduceat(x[at], first))
        known = pa.array(np.add.reduceat((count > 0)[at].astype(np.int64), first))
        return pa.Table.from_arrays([*kept.columns, pa.array(n), known, total(base), total(logs)], schema=schema)

    return run


def fit(cells: DataFrame, model: Model, rounds: int) -> Model:
    """Seats the cells, round by round. What comes to the driver is as long as the lists of restaurants and frequent words."""
    cells = cells.select("words", "lengths", "contexts", "counts")
    for number in range(rounds + 1):
        sums = cells.mapInArrow(releasing(_totals(model)), SUMS).groupBy("kind", "place").agg(F.sum("value").alias("value")).toArrow()
        kind, place, value = (sums.column(i).to_numpy() for i in range(3))

        def of(which, size, kind=kind, place=place, value=value):
            out = np.zeros(size, np.int64)
            out[place[kind == which]] = value[kind == which]
            return out

        tables, customers, root = of(TABLES, model.restaurants), of(FREQUENT, len(model.frequent)), of(ROOT, 2)
        if not number:
            model.customers = of(CUSTOMERS, model.restaurants)
            words_of = of(WORDS_OF, 3) + np.bincount(customers[customers < 3], minlength=3)
            # the usual estimate from how many have one and two
            share = lambda x: float(np.clip((x[1] + 0.5) / (x[1] + 2 * x[2] + 1.0), 0.05, 0.95))
            model.discounts = share(words_of), share(of(CELLS_OF, 3))
            seated = np.minimum(customers, 1)
        else:
            base = np.full(len(customers), 1 / (model.known + 1))
            seated = draw_tables(customers, model.rounds[-1].root_tables - seated, base, model.discounts[0], model.frequent, number)
        state = Round(tables, int(root[0] + customers.sum()), int(root[1] + seated.sum()), np.zeros(0))
        state.frequent = model.root(customers, seated, state)
        model.rounds.append(state)
    return model


def word_model(texts: DataFrame) -> Model:
    """The training tokens of texts (text, trains) and the words that have restaurants."""
    found = texts.where("trains").select("text").mapInArrow(releasing(_word_counts), "word long, n long")
    words = materialise(found.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    tokens, known = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = words.where(F.col("n") * SHARE >= tokens).toArrow()
    hashes, counts = frequent.column("word").to_numpy().view(np.uint64), frequent.column("n").to_numpy()
    order = np.argsort(hashes)
    return Model(tokens, known, hashes[order], counts[order])


def score_texts(docs: DataFrame, trains: Column, keep=("doc_id",), burned: int = BURNED, kept: int = KEPT) -> DataFrame:
    """The columns `keep` of docs with n_tokens, n_known, train_tokens, base_score and score; rows where `trains` holds are learnt from. Written to the shared folder and read from there."""
    spark = docs.sparkSession
    short_batches(spark)
    keep = [c for c in keep if c.lower() not in OUTPUTS]
    names = [f"kept_{i}" for i in range(len(keep))]
    texts = docs.select(text_or_empty().alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"), *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)])
    result = shared_dir(spark, "lm-scores")
    with scratch(spark):
        model = word_model(texts)
        folder = shared_dir(spark, "lm-sequences")
        buckets = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES
        sent = texts.mapInArrow(releasing(_blocks(model, folder, buckets)), SENT)
        cells = materialise(sent.groupBy("bucket").applyInArrow(_meet, CELLS), "lm-cells")
        model = fit(cells, model, burned + kept)
        back = cells.mapInArrow(releasing(_answers(model, burned)), BACK)
        fields = [*(T.StructField(n, docs.schema[c].dataType) for c, n in zip(keep, names, strict=True)), *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known")), *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score"))]
        schema = T.StructType(fields)
        found = back.groupBy("block").applyInArrow(_assemble(model, folder, to_arrow_schema(schema)), schema)
        found = found.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
        return materialise(found, "lm-scores", result)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def op12_lm(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    return score_texts(docs, ~F.col("held_out"), ("doc_id", "held_out"))
