"""Document quality by a linear-chain conditional random field over lines.

Every line that is not blank is good or bad. Its features are shares of byte classes, word and repetition measures; the
features of the lines before and after it, zero at the ends, are its features too. The CRF has a weight for each feature and
a score for each pair of neighbouring labels. Forward-backward gives each line's marginal of being good;
a document's raw score is the mean of these, weighted by line lengths, and a logistic curve fitted on the training
documents turns it into the score.

Training takes the labelled documents whose crc32(doc_id) mod 3 is not 1, at most `TRAIN_DOCS` of them in the order of a
hash of their id: a bounded sample of labelled rows. Of rows that repeat a chosen id one trains, the one whose text is first by its hash. Documents
train whole; one that would bring the lines beyond `TRAIN_LINES` is passed over, so that at most so many lines' features come to the driver. Every line of a
document has its document's label. Labels, language, source and id never enter a score. Scoring is a scan, over all lines.

Rows. Null or blank texts are one empty line and get a score. A null doc_id is not held out and never trains.
Null labels don't train; a document with several labels trains with each. Repeated rows all come back. Without
training rows of both labels every score is 0.5. Empty tables give no rows. Other columns pass through; one called
`quality_score` gives way to the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.llm.common import materialise, read_table, releasing, short_batches, small_batches, text_or_empty, values_bytes
from glossweave.llm.words import HASH_BYTES, hashed_words, span_hashes

#: The bound of the training sample: documents, and lines of all of them together.
TRAIN_DOCS = 4000
TRAIN_LINES = 400_000
ROUNDS = 200
L2 = 1e-3
FEATURES = ("log_bytes", "upper", "digits", "punctuation", "marks", "exclaim", "space", "word_length", "distinct", "echo", "odd_ends", "sentence_end", "line_again", "not_ascii", "one_word")


def _classes() -> np.ndarray:
    """For each byte, bits: 1 letter, 2 upper, 4 digit, 8 punctuation, 16 mark of markup, 32 ! or ?, 64 space, 128 not ASCII."""
    out = np.zeros(256, np.uint8)
    out[128:] = 1 | 128
    for c in range(128):
        s = chr(c)
        out[c] = s.isalpha() * 1 | s.isupper() * 2 | s.isdigit() * 4 | (c > 32 and not s.isalnum()) * 8 | (s in "#$%&*^~<>{}[]\\/=_|@") * 16 | (s in "!?") * 32 | (c <= 32) * 64
    return out


CLASSES = _classes()


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes of each line, first line of each text): a row for each line that is not blank, one at least for each text."""
    cuts = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], cuts + 1]))
    starts = starts[starts < len(data)]
    h, ws, we, _ = hashed_words(data, offsets, False)
    line_of_word = np.searchsorted(starts, ws, "right") - 1
    n_words = np.bincount(line_of_word, minlength=len(starts))
    kept = np.flatnonzero(n_words)
    renamed = np.full(len(starts) + 1, -1)
    renamed[kept] = np.arange(len(kept))
    line = renamed[line_of_word]
    n, n_words = len(kept), n_words[kept].astype(float)
    # a line's span: from its first word to its last
    first = np.searchsorted(line, np.arange(n))
    last = np.searchsorted(line, np.arange(n), "right") - 1
    a, b = ws[first], we[last]
    size = (b - a).astype(float)
    kinds = CLASSES[data]

    def share(bit):
        sums = np.concatenate([[0], np.cumsum((kinds & bit) != 0)])
        return sums[b] - sums[a]

    letters = share(1)
    order = np.lexsort((h, line))
    new = np.r_[True, (line[order][1:] != line[order][:-1]) | (h[order][1:] != h[order][:-1])] if len(h) else np.zeros(0, bool)
    distinct = np.bincount(line[order][new], minlength=n)
    echo = np.bincount(line[1:][(h[1:] == h[:-1]) & (line[1:] == line[:-1])], minlength=n)
    odd = np.bincount(line[(kinds[we - 1] & 1) == 0], minlength=n)
    doc = np.searchsorted(offsets, a, "right") - 1
    lines = span_hashes(data, a, b)
    by = np.lexsort((lines, doc))
    same = np.r_[False, (doc[by][1:] == doc[by][:-1]) & (lines[by][1:] == lines[by][:-1])] if n else np.zeros(0, bool)
    again = np.zeros(n)
    again[by] = same | np.r_[same[1:], False] if n else again
    x = np.column_stack([
        np.log1p(size) / 5, share(2) / np.maximum(1, letters), share(4) / size, share(8) / size, share(16) / size, share(32) / size, share(64) / size,
        (size / n_words) / 10, distinct / n_words, echo / n_words, odd / n_words, np.isin(data[b - 1], (46, 33, 63)), again, share(128) / size, n_words == 1,
    ]).astype(np.float64) if n else np.zeros((0, len(FEATURES)))
    # texts without a word: one line without bytes or features
    texts = np.arange(len(offsets) - 1)
    bare = np.setdiff1d(texts, doc)
    doc = np.concatenate([doc, bare])
    order = np.argsort(doc, kind="stable")
    x = np.concatenate([x, np.zeros((len(bare), len(FEATURES)))])[order]
    size = np.concatenate([size, np.zeros(len(bare))])[order]
    return x, size, np.searchsorted(doc[order], np.arange(len(offsets)))


def with_neighbours(x: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Each line's features with those of the line before and after in its text, and ones."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[firsts[:-1]] = 0
    after[firsts[1:] - 1] = 0
    return np.column_stack([x, before, after, np.ones(len(x))])


def marginals(unary: np.ndarray, firsts: np.ndarray, pairs: np.ndarray):
    """Forward-backward over all texts at once.

    unary: the score of each line's being good. pairs: scores of (label, next label). Returns each line's
    marginal of being good, the expected counts of the pairs for each text, and the log of each text's partition sum.
    """
    n = np.diff(firsts)
    order = np.argsort(-n, kind="stable")
    starts, n = firsts[:-1][order], n[order]
    top = np.maximum(unary, 0)
    e = np.exp(np.column_stack([-top, unary - top]))
    move = np.exp(pairs)
    alpha, beta, log_z = np.zeros_like(e), np.ones_like(e), np.zeros(len(n))
    live = [int(np.searchsorted(-n, -t, "left")) for t in range(int(n[0]))] if len(n) else []
    for t, m in enumerate(live):
        at = starts[:m] + t
        a = e[at] * (alpha[at - 1] @ move if t else 1.0)
        s = a.sum(1, keepdims=True)
        alpha[at] = a / s
        log_z[:m] += np.log(s[:, 0]) + top[at]
    counts = np.zeros((len(n), 2, 2))
    for t in reversed(range(1, len(live))):
        m = live[t]
        at = starts[:m] + t
        right = e[at] * beta[at]
        b = right @ move.T
        s = b.sum(1, keepdims=True)
        joint = alpha[at - 1][:, :, None] * move * right[:, None, :]
        counts[:m] += joint / joint.sum((1, 2), keepdims=True)
        beta[at - 1] = b / s
    p = alpha * beta
    back = np.empty(len(n), int)
    back[order] = np.arange(len(n))
    return p[:, 1] / p.sum(1), counts[back], log_z[back]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray
    curve: tuple[float, float]

    def raw(self, x: np.ndarray, size: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        p, _, _ = marginals(with_neighbours((x - self.mean) / self.scale, firsts) @ self.weights, firsts, self.pairs)
        weight = size + 1.0
        return np.add.reduceat(p * weight, firsts[:-1]) / np.add.reduceat(weight, firsts[:-1]) if len(firsts) > 1 else np.zeros(0)

    def score(self, x, size, firsts) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * logit(self.raw(x, size, firsts)) + self.curve[1])))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(x: np.ndarray, size: np.ndarray, firsts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, l2: float = L2) -> Model:
    """Maximum penalised likelihood of the line labels by Adam over all training documents at once."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = with_neighbours((x - mean) / scale, firsts)
    line_label = np.repeat(labels, np.diff(firsts)).astype(float)
    # each document counts by the root of its lines, so that long ones do not drown the others
    weight = 1 / np.sqrt(np.diff(firsts))
    line_weight = np.repeat(weight, np.diff(firsts))
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels, labels), weight * (np.diff(firsts) - 1))
    theta = np.zeros(z.shape[1] + 4)
    m = v = np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, pairs = theta[:-4], theta[-4:].reshape(2, 2)
        p, counts, _ = marginals(z @ w, firsts, pairs)
        g = np.concatenate([z.T @ ((line_label - p) * line_weight), (seen - (counts * weight[:, None, None]).sum(0)).ravel()]) / weight.sum() - l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Model(mean, scale, theta[:-4], theta[-4:].reshape(2, 2), (1.0, 0.0))
    s, a, b = logit(model.raw(x, size, firsts)), 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic regression with a small ridge
        p = 1 / (1 + np.exp(-(a * s + b)))
        g = np.array([(s * (labels - p)).sum() - 1e-2 * a, (labels - p).sum() - 1e-2 * b])
        q = p * (1 - p)
        h = np.array([[(s * s * q).sum() + 1e-2, (s * q).sum()], [(s * q).sum(), q.sum() + 1e-2]])
        a, b = np.array([a, b]) + np.linalg.solve(h, g)
    model.curve = (float(a), float(b))
    return model


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def _feature_rows(batches):
    for batch in small_batches(batches, most=HASH_BYTES):
        x, size, firsts = line_features(*values_bytes(batch.column("text")))
        parts = [(b - a, x[a:b].astype(np.float32).tobytes(), size[a:b].tobytes()) for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
        columns = [pa.array([p[k] for p in parts], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("quality"), *columns], names=["at", "quality", "lines", "x", "size"])


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, most_lines: int = TRAIN_LINES) -> Model | None:
    """Fits the CRF on at most `most` labelled documents with `most_lines` lines; None without two labels."""
    spark = docs.sparkSession
    labelled = labels.where(F.col("quality").isin(0, 1) & ~held_out()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = labelled.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    short_batches(spark)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    one = texts.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = one.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id").alias("at"), "quality", "text")
    rows = materialise(rows.mapInArrow(releasing(_feature_rows), "at long, quality int, lines long, x binary, size binary"), "quality-training")
    kept, left = [], most_lines
    for r in sorted(rows.select("at", "quality", "lines").collect()):
        if r.lines <= left:
            kept.append((r.at, r.quality))
            left -= r.lines
    kept = F.broadcast(spark.createDataFrame(kept, "at long, quality int"))
    got = sorted((r.quality, bytes(r.x), bytes(r.size)) for r in rows.join(kept, ["at", "quality"], "left_semi").collect())
    quality = np.array([q for q, _, _ in got], int)
    if len(set(quality.tolist())) < 2:
        return None
    x = np.frombuffer(b"".join(a for _, a, _ in got), np.float32).reshape(-1, len(FEATURES)).astype(np.float64)
    size = np.frombuffer(b"".join(s for _, _, s in got), np.float64)
    firsts = np.concatenate([[0], np.cumsum([len(s) // 8 for _, _, s in got])])
    return fit(x, size, firsts, quality)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with quality_score."""
    short_batches(docs.sparkSession)
    docs = docs.drop("quality_score")

    def run(batches):
        for batch in small_batches(batches, most=HASH_BYTES):
            at = batch.schema.get_field_index("text")
            text = batch.column(at)
            text = text.fill_null("") if text.null_count else text
            out = np.full(batch.num_rows, 0.5) if model is None else model.score(*line_features(*values_bytes(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "quality_score"])

    return docs.mapInArrow(releasing(run), T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
