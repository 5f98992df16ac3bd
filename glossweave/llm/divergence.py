"""How far the sources of a language differ in their use of terms, by a three-dimensional cube of tasks.

Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased. Each language keeps the terms that stand in enough of its documents. A group, the
documents of one source in one language, gives a kept term that it holds `count` times the smoothed share
p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), N being its occurrences of kept terms and V their number. Two groups diverge by the
sum of |p - q| over all kept terms; a term's own divergence from its language is p - q.

All pairs of groups over all terms are a cube. A task owns a cell of it, (group block, group block, term block): the slices of the table of
counts that it needs are replicated to it, one row for each partner block, it lays them out as two small dense matrices and gives each pair's partial
divergence over its terms; partial sums are added along the term axis. Groups and terms have dense numbers in their language, so that a cell's
matrices are bounded by GROUP_BLOCK and TERM_BLOCK however large a source, a language or a term is. Only half of the cube is computed, as
the divergence is symmetric. A source is counted where its documents lie, in Arrow batches, and Spark adds up the counts before it shuffles them.

Rows. A null text, language or source is ''. A text without terms still makes its group. A language without kept terms has pairs of value 0 and
no terms. Repeated rows are documents of their own. Equal values are ordered by item. No rows give none. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.common import gathered, materialise, read_table, releasing, short_batches, text_or_empty, values_bytes
from glossweave.llm.words import lower_ascii, span_hashes
from glossweave.plans.storage import lookup, numbered, stored

LEAST_DOCUMENTS, SHOWN = 30, 50
UNIT, PRIOR = 1_000_000_000, 5
#: Groups and terms of a cell at most: its two matrices have 2 MB each.
GROUP_BLOCK, TERM_BLOCK = 128, 2048
#: Bytes of text whose terms are counted together.
COUNTED_BYTES = 4 << 20


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the terms of texts that lie end to end."""
    inside = (data >= 128) | ((data | 32) - np.uint8(97) < 26)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes()))


def _counts(batches):
    """(lang, source, term, n, df) of some documents at a time: occurrences, and documents with the term."""
    for batch in gathered(batches, "text", COUNTED_BYTES):
        data, offsets = values_bytes(batch.column("text"))
        data = lower_ascii(data)
        starts, ends = term_spans(data, offsets)
        if not len(starts):
            continue
        _, first, term = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        doc = np.searchsorted(offsets, starts, "right") - 1
        groups = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], names=["lang", "source"])
        names = list(dict.fromkeys(map(tuple, (g.values() for g in groups.to_pylist()))))
        place = {g: i for i, g in enumerate(names)}
        of_doc = np.array([place[tuple(g.values())] for g in groups.to_pylist()], np.int64)
        pairs, n = np.unique(doc * len(first) + term, return_counts=True)
        cells, cell = np.unique(of_doc[pairs // len(first)] * len(first) + pairs % len(first), return_inverse=True)
        n, df = np.bincount(cell, weights=n).astype(np.int64), np.bincount(cell)
        group, term = cells // len(first), cells % len(first)
        words = _strings(data, starts[first], ends[first]).take(pa.array(term))
        lang, source = (pa.array([g[i] for g in names], pa.string()).take(pa.array(group)) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([lang, source, words, pa.array(n), pa.array(df.astype(np.int64))], names=["lang", "source", "term", "n", "df"])


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a count, in exact decimals: counts of any corpus times 10^9 fit in 38 digits."""
    wide = lambda c: c.cast("decimal(20,0)")
    over, under = (wide(count) + F.lit(PRIOR)) * F.lit(UNIT), wide(total) + wide(terms) * F.lit(PRIOR)
    return F.call_function("div", over.cast("decimal(38,0)"), under.cast("decimal(38,0)")) + F.lit(1).cast("long")


def _cell(group_block: int):
    """A pair's partial divergences over a block of terms. Rows with col -1 are the groups: p is then that of a count of 0."""

    def run(table: pa.Table) -> pa.Table:
        get = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        gid, col, p = get("gid"), get("col"), get("p")
        width = int(get("width")[0])
        head = np.flatnonzero(col < 0)
        head = head[np.argsort(gid[head])]
        groups = gid[head]
        m = np.repeat(p[head][:, None], width, 1)
        entry = np.flatnonzero(col >= 0)
        m[np.searchsorted(groups, gid[entry]), col[entry]] = p[entry]
        sources = table.column("source").combine_chunks().take(pa.array(head))
        block = groups // group_block
        same = block[0] == block[-1]
        first = np.arange(len(groups)) if same else np.flatnonzero(block == block[0])
        others = first if same else np.flatnonzero(block == block[-1])
        i, j, value = [], [], []
        for a in first.tolist():
            with_ = others[others > a]
            if len(with_):
                i.append(np.full(len(with_), a))
                j.append(with_)
                value.append(np.abs(m[with_] - m[a]).sum(1))
        i, j, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (i, j, value))
        lang = pa.repeat(table.column("lang")[0], len(i))
        return pa.Table.from_arrays([lang, sources.take(pa.array(i)), sources.take(pa.array(j)), pa.array(value, pa.int64())], names=["lang", "a", "b", "value"])

    return run


def divergences(docs: DataFrame, least: int = LEAST_DOCUMENTS, shown: int = SHOWN, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language by divergence (part pair), and the terms that a source has more of than its language, up to `shown` (part term)."""
    spark = docs.sparkSession
    short_batches(spark)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], text_or_empty().alias("text"))
    found = named.mapInArrow(releasing(_counts), "lang string, source string, term string, n long, df long")
    counts = materialise(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "divergence-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("df").alias("df")).where(F.col("df") >= least).drop("df")
    terms = materialise(numbered(terms, ["lang"], ["term"], "tid"), "divergence-terms")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("lang_n"))
    kept = materialise(lookup(counts.drop("df"), terms, ["lang", "term"], "inner"), "divergence-kept")
    groups = numbered(named.select("lang", "source").distinct(), ["lang"], ["source"], "gid")
    groups = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left")
    groups = groups.join(groups.groupBy("lang").agg(F.count("*").alias("groups")), "lang").join(sizes, "lang", "left")
    groups = stored(groups.fillna(0, ["group_n", "v", "lang_n"]), "divergence-groups")
    # without kept terms the smoothed share has no denominator
    zero = F.when(F.col("v") > 0, share(F.lit(0), F.col("group_n"), F.col("v"))).otherwise(F.lit(0).cast("long"))
    rated = lookup(kept, groups, ["lang", "source"], "inner")
    rated = rated.select("lang", "source", "term", "gid", "tid", "groups", "v", share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"), share(F.col("all"), F.col("lang_n"), F.col("v")).alias("q"))

    def cells(df: DataFrame) -> DataFrame:
        """df once for each cell that its group and term block take part in."""
        own, partner = F.floor(F.col("gid") / group_block), F.col("partner")
        df = df.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("groups") - 1) / group_block))))
        width = F.least(F.lit(term_block), F.col("v") - F.col("terms") * term_block).cast("int")
        return df.select("lang", F.least(own, partner).alias("one"), F.greatest(own, partner).alias("two"), "terms", "gid", "col", "p", width.alias("width"), "source")

    entries = cells(rated.select("lang", "gid", "groups", "v", F.floor(F.col("tid") / term_block).alias("terms"), (F.col("tid") % term_block).cast("int").alias("col"), "p", F.lit(None).cast("string").alias("source")))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("v") - 1) / term_block), F.lit(0).cast("long"))))
    heads = cells(groups.select("lang", "gid", "groups", "v", blocks.alias("terms"), F.lit(-1).alias("col"), zero.alias("p"), "source"))
    partial = entries.unionByName(heads).groupBy("lang", "one", "two", "terms").applyInArrow(_cell(group_block), "lang string, a string, b string, value long")
    whole = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = whole.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    own = rated.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= shown)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(ranked)


def op11_divergence(spark, sf_dir: str) -> DataFrame:
    return divergences(read_table(spark, sf_dir, "documents"))


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
terms AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}),
kept AS (SELECT c.* FROM counts c SEMI JOIN terms t ON c.lang = t.lang AND c.term = t.term),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT g.lang, g.source, (SELECT count(*) FROM terms t WHERE t.lang = g.lang) AS v, coalesce(k.n, 0) AS n
  FROM groups g LEFT JOIN (SELECT lang, source, sum(n) AS n FROM kept GROUP BY ALL) k ON k.lang = g.lang AND k.source = g.source),
shares AS (
  SELECT s.lang, s.source, t.term, coalesce(k.n, 0) AS n, 1 + ({UNIT}::HUGEINT * (coalesce(k.n, 0) + {PRIOR})) // (s.n + {PRIOR} * s.v)::HUGEINT AS p
  FROM sizes s JOIN terms t ON t.lang = s.lang LEFT JOIN kept k ON k.lang = s.lang AND k.source = s.source AND k.term = t.term),
overall AS (
  SELECT lang, term, 1 + ({UNIT}::HUGEINT * (sum(n) + {PRIOR})) // (sum(sum(n)) OVER (PARTITION BY lang) + {PRIOR} * count(*) OVER (PARTITION BY lang))::HUGEINT AS q
  FROM kept GROUP BY lang, term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
own AS (SELECT s.lang, s.source, 'term' AS part, s.term AS item, s.p - o.q AS value FROM shares s JOIN overall o ON o.lang = s.lang AND o.term = s.term WHERE s.n > 0 AND s.p > o.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= {SHOWN}
"""
