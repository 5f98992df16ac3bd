"""What the jobs take as input, derived from the given tables by rules that SQL states as well.

The corpus pairs each sentence of a document with the next. Word classes, lemmas, overrides and exceptions are buckets of a
word's md5, vectors are rows of `embeddings`; so every job runs over all documents and whole texts.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.config import Negators, PairConfig
from glossweave.functions.text import strip_marks, tokenize, tokens
from glossweave.operators.align import PAIRS, PHRASES, group_facts, in_steps, link_step, phrase_step, sentence_links, vectors_at_hand
from glossweave.plans.storage import read_table, spread

SENTENCE = r"[^.!?\n]+[.!?]*"
#: Sentence pairs of a document at most, for row positions; a longer document raises an error.
SENTENCES = 1 << 20
#: Scale of the integer dot product and the threshold on it, for vectors of unit length times 256.
SCALE = 10.0 / 65536
THRESHOLD = 0.2


#: The pair that the corpus is aligned as: negators are words that it has.
CONFIG = PairConfig("la1", "la2", (Negators(("is", "of"), 1),), (Negators(("to",), 1), Negators(("de",), -1)), True, threshold=THRESHOLD, scale=SCALE)


def md5_digit(c: Column, at: int = 1) -> Column:
    return F.substring(F.md5(F.lower(c)), at, 1)


def _neighbours(spark: SparkSession, sf_dir: str, of) -> DataFrame:
    """row_pos, id, lang, x1, x2: what `of` makes of each sentence, once, and of the one after it."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    docs = docs.select("doc_id", "lang", of(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(SENTENCE), 0)).alias("ss"))
    rest = F.greatest(F.size("ss") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("ss", F.lit(1), rest), F.slice("ss", F.lit(2), rest), lambda a, b: F.struct(a.alias("x1"), b.alias("x2")))
    rows = docs.select("doc_id", "lang", F.posexplode(pairs).alias("j", "p"))
    passed = F.raise_error(F.concat(F.lit(f"more than {SENTENCES} sentence pairs in document "), F.col("doc_id").cast("string")))
    row_pos = F.when(F.col("j") >= SENTENCES, passed.cast("long")).otherwise(F.col("doc_id") * SENTENCES + F.col("j"))
    return rows.select(row_pos.alias("row_pos"), F.concat_ws("-", "doc_id", "j").alias("id"), "lang", "p.x1", "p.x2")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_pos, id, s1, s2, commands, invalid, lang."""
    rows = _neighbours(spark, sf_dir, lambda ss: ss)
    return rows.select("row_pos", "id", F.col("x1").alias("s1"), F.col("x2").alias("s2"), F.lit("{}").alias("commands"), F.lit("False").alias("invalid"), "lang")


def corpus_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_pos, id, w1, w2: the tokens of both sides."""
    rows = _neighbours(spark, sf_dir, lambda ss: F.transform(ss, lambda s: tokenize(strip_marks(s))))
    return rows.select("row_pos", "id", F.col("x1").alias("w1"), F.col("x2").alias("w2"))


def digest(word: Column) -> Column:
    """What a word's class and vector are drawn from."""
    return F.md5(F.lower(word))


def code_of(word: Column, digest: Column) -> Column:
    """The class of a word in the derived lexicon, by the first digit of its digest; the last four digits have none."""
    code = F.translate(F.substring(digest, 1, 1), "0123456789abcdef", "nnnnnnvvvaar")
    return F.when(word.rlike(r"^[\p{L}\p{N}]+$"), code).otherwise("")


def lexicon_code(word: Column) -> Column:
    return code_of(word, digest(word))


def corpus_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_pos, side (1, 2), idx, word for both sides of the corpus."""
    c = corpus(spark, sf_dir)
    return tokens(c, "s1", ["row_pos", F.lit(1).alias("side")]).unionByName(tokens(c, "s2", ["row_pos", F.lit(2).alias("side")]))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word: the distinct tokens of the documents' first sides, as they are."""
    return tokens(corpus(spark, sf_dir), "s1", []).select("word").distinct()


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, tag: a tag of the Penn set for the words of the lexicon's classes."""
    code = lexicon_code(F.col("word"))
    tag = F.when(code == "n", "NN").when(code == "v", "VBD").when(code == "a", "JJ").when(code == "r", "RB")
    return vocabulary(spark, sf_dir).withColumn("tag", tag).where("tag IS NOT NULL")


def lemma_of(word: Column) -> Column:
    stem = F.regexp_replace(F.lower(word), "(ing|en|ed|es|s)$", "")
    return F.when(F.length(stem) >= 3, stem).otherwise(F.lower(word))


def phrase_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """pos, w, n of the content words of a batch of sentences (w1, p1), and of two such words of one class that follow each other."""
    words, pos = (batch.column(batch.schema.get_field_index(c)) for c in ("w1", "p1"))
    row = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    words, coded = words.flatten(), pos.flatten().dictionary_encode()
    code = coded.indices.to_numpy()
    content = np.asarray(pc.not_equal(coded.dictionary, ""))[code] if len(code) else np.zeros(0, bool)
    one = np.flatnonzero(content)
    two = np.flatnonzero(content[:-1] & (code[1:] == code[:-1]) & (row[1:] == row[:-1]))
    first, after = pa.array(two), pa.array(two + 1)
    each = pa.concat_arrays([words.take(pa.array(one)), pc.binary_join_element_wise(words.take(first), words.take(after), " ")])
    kinds = pa.array(np.concatenate([code[one], code[two]]), pa.int32())
    counted = pa.table({"pos": kinds, "w": each}).group_by(["pos", "w"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
    named, w, n = (counted.column(c).combine_chunks() for c in ("pos", "w", "count_all"))
    return pa.RecordBatch.from_arrays([coded.dictionary.take(named), w, n], names=["pos", "w", "n"])


def word_list(spark: SparkSession, sf_dir: str, words: DataFrame | None = None) -> DataFrame:
    """pos, word, id: lemmas and two-word phrases of one class on side 1 that are there often enough, with an id from their md5. words: w1, p1 of the corpus, if they are at hand."""
    rows, steps = (corpus_words(spark, sf_dir), lambda: [word_step(1), phrase_counts]) if words is None else (words.select("w1", "p1"), lambda: [phrase_counts])
    found = rows.mapInArrow(in_steps(steps), "pos string, w string, n bigint")
    # a word's lemma once for each distinct word
    found = found.groupBy("pos", "w").agg(F.sum("n").alias("n")).select("pos", lemma_of(F.col("w")).alias("word"), "n")
    return found.groupBy("pos", "word").agg(F.sum("n").alias("n")).where("n >= 3").select("pos", "word", word_id(F.col("word")).alias("id"))


def word_id(word: Column) -> Column:
    return F.conv(F.substring(F.md5(word), 1, 13), 16, 10).cast("long")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, vec: whole numbers, so that products are the same in any order."""
    return read_table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vec"))


def vector_of(digest: Column, count: Column) -> Column:
    """The row of the vectors that a word with this digest has."""
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % count


#: Words of a task whose classes are kept from batch to batch.
KNOWN_WORDS = 1 << 17
CLASSES = (*"nnnnnnvvvaar", "", "", "", "")


def word_classes(words: pa.Array, vectors: int, known: dict | None = None) -> tuple[pa.Array, pa.Array]:
    """The class (as code_of) and the vector (as vector_of) of each word, made once for each distinct one. known: the words of batches before, at most KNOWN_WORDS."""
    known = {} if known is None else known
    coded = words.fill_null("").dictionary_encode()

    def found(w: str) -> int:
        # a token is a run of letters and digits or one other character; 24 bits of the digest and one for it
        return int.from_bytes(md5(w.lower().encode()).digest()[:3]) << 1 | (w.isalnum() if w.isascii() else unicodedata.category(w[0])[0] in "LN")

    each, md5 = coded.dictionary.to_pylist(), hashlib.md5
    heads = [known.get(w) for w in each]
    for i in [i for i, h in enumerate(heads) if h is None]:
        if len(known) >= KNOWN_WORDS:
            known.clear()
        known[each[i]] = heads[i] = found(each[i])
    heads = np.array(heads, np.int64)
    classes = pa.array(CLASSES, pa.string()).take(pa.array(np.where(heads & 1, heads >> 21, 12)))
    return classes.take(coded.indices), pa.array((heads >> 1) % max(1, vectors)).take(coded.indices)


WORDS = "row_pos bigint, id string, " + ", ".join(f"w{k} array<string>, p{k} array<string>, n{k} array<bigint>" for k in (1, 2))


def word_step(n: int):
    """Of a batch of row_pos, id, w1, w2: row_pos, id, w1, p1, n1, w2, p2, n2, with the classes and, of n vectors, those of the words."""
    known: dict = {}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        row_pos, id_, *sides = batch.columns
        columns = [row_pos, id_]
        # a sentence is the second of one pair and the first of the next, so both sides' words are looked at together
        flat = [words.flatten() for words in sides]
        found, at = word_classes(pa.concat_arrays(flat), n, known), 0
        for words, some in zip(sides, flat, strict=True):
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.diff(np.asarray(words.offsets)))]).astype(np.int32))
            columns += [words, *(pa.ListArray.from_arrays(offsets, x.slice(at, len(some))) for x in found)]
            at += len(some)
        return pa.RecordBatch.from_arrays(columns, names=["row_pos", "id", "w1", "p1", "n1", "w2", "p2", "n2"])

    return step


def tokenised(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(row_pos, id, w1, p1, n1, w2, p2, n2: words, classes and vectors' ids of both sides; the vectors)."""
    vecs = vectors(spark, sf_dir)
    n = vecs.count()
    return corpus_words(spark, sf_dir).mapInArrow(in_steps(lambda: [word_step(n)]), WORDS), vecs


PHRASED = f"row_pos bigint, w1 array<string>, p1 array<string>, pairs {PAIRS}, phrases {PHRASES}"


def aligned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_pos, id, w1, p1, w2, p2, links, groups: the corpus with its links, in one row for each sentence pair."""
    rows, vecs = tokenised(spark, sf_dir)
    return sentence_links(rows, vecs, SCALE, THRESHOLD)


def phrased_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_pos, w1, p1, pairs, phrases (as phrase_step gives them) of the corpus: its words, links, groups and candidates are made in one task, and only these leave it."""
    rows, vecs = tokenised(spark, sf_dir)
    known, sides = vectors_at_hand(rows, vecs)
    last = [link_step(sides, SCALE, THRESHOLD), phrase_step(CONFIG)]
    if known is not rows:
        # the vectors are too many to be at hand, and joined first
        return known.mapInArrow(in_steps(lambda: last), PHRASED)
    n = vecs.count()
    return corpus_words(spark, sf_dir).mapInArrow(in_steps(lambda: [word_step(n), *last]), PHRASED)


def distinct_pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """w1, w2: the distinct linked words of a batch of rows with pairs."""
    each = batch.column(batch.schema.get_field_index("pairs")).flatten()
    found = pa.table({c: each.field(c) for c in ("w1", "w2")}).group_by(["w1", "w2"], use_threads=False).aggregate([]).combine_chunks()
    return pa.RecordBatch.from_arrays([found.column(c).combine_chunks() for c in ("w1", "w2")], names=["w1", "w2"])


def exceptions(rows: DataFrame) -> DataFrame:
    """norm1, norm2: a sixteenth of the pairs of linked words' lemmas. rows: with pairs, or with w1, w2 and links."""
    if "pairs" not in rows.columns:
        rows = rows.select(F.transform("links", lambda x: F.struct(F.get("w1", x["i"]).alias("w1"), F.get("w2", x["j"]).alias("w2"))).alias("pairs"))
    words = rows.select("pairs").mapInArrow(in_steps(lambda: [distinct_pairs]), "w1 string, w2 string")
    pairs = words.select(lemma_of(F.col("w1")).alias("norm1"), lemma_of(F.col("w2")).alias("norm2"))
    return pairs.where(F.substring(F.md5(F.concat("norm1", "norm2")), 1, 1) == "0").distinct()


def corpus_facts(spark: SparkSession, sf_dir: str, linked: DataFrame | None = None) -> DataFrame:
    """The facts of the corpus, with seq and the row's id. linked: its rows with links, which come from vectors otherwise."""
    from glossweave.operators.count import fact_order
    from glossweave.plans.storage import stored

    rows = stored(phrased_rows(spark, sf_dir) if linked is None else linked.mapInArrow(in_steps(lambda: [phrase_step(CONFIG)]), PHRASED), "aligned")
    listed = stored(word_list(spark, sf_dir, rows), "word-list")
    groups = rows.select("row_pos", F.inline("phrases"))
    facts = group_facts(groups, CONFIG, listed, listed, exceptions(rows), lambda phrase, pos, side: lemma_of(phrase))
    row_id = F.concat_ws("-", F.floor(F.col("row_pos") / SENTENCES), F.col("row_pos").bitwiseAND(SENTENCES - 1))
    return fact_order(facts).withColumn("id", row_id)


#: The same inputs in DuckDB's SQL.
SQL = {
    "corpus": r"""
_ss AS (SELECT doc_id, lang, regexp_extract_all(coalesce(text, ''), '[^.!?\n]+[.!?]*') AS ss FROM documents),
_sent AS (SELECT doc_id, lang, unnest(ss) AS s, generate_subscripts(ss, 1) - 1 AS j FROM _ss),
corpus AS (
  SELECT a.doc_id * 1048576 + a.j AS row_pos, a.doc_id || '-' || a.j AS id, a.s AS s1, b.s AS s2, '{}' AS commands, 'False' AS invalid, a.lang
  FROM _sent a JOIN _sent b ON a.doc_id = b.doc_id AND b.j = a.j + 1)""",
    "tokens": r"""
_t1 AS (SELECT row_pos, 1 AS side, regexp_extract_all(replace(s1, '@', ''), '[\p{L}\p{N}]+|[^\s]') AS t FROM corpus
  UNION ALL SELECT row_pos, 2, regexp_extract_all(replace(s2, '@', ''), '[\p{L}\p{N}]+|[^\s]') FROM corpus),
_t2 AS (SELECT row_pos, side, unnest(t) AS word, generate_subscripts(t, 1) - 1 AS idx FROM _t1),
tokens AS (SELECT *, CASE WHEN NOT regexp_matches(word, '^[\p{L}\p{N}]+$') THEN ''
    WHEN substr(md5(lower(word)), 1, 1) < '6' THEN 'n' WHEN substr(md5(lower(word)), 1, 1) < '9' THEN 'v'
    WHEN substr(md5(lower(word)), 1, 1) < 'b' THEN 'a' WHEN substr(md5(lower(word)), 1, 1) < 'c' THEN 'r' ELSE '' END AS pos,
  CASE WHEN length(regexp_replace(lower(word), '(ing|en|ed|es|s)$', '')) >= 3 THEN regexp_replace(lower(word), '(ing|en|ed|es|s)$', '') ELSE lower(word) END AS lemma
  FROM _t2)""",
    "word_list": r"""
_listable AS (
  SELECT pos, lemma AS word FROM tokens WHERE side = 1 AND pos <> ''
  UNION ALL SELECT a.pos, CASE WHEN length(regexp_replace(lower(a.word || ' ' || b.word), '(ing|en|ed|es|s)$', '')) >= 3
      THEN regexp_replace(lower(a.word || ' ' || b.word), '(ing|en|ed|es|s)$', '') ELSE lower(a.word || ' ' || b.word) END
  FROM tokens a JOIN tokens b ON a.row_pos = b.row_pos AND a.side = 1 AND b.side = 1 AND b.idx = a.idx + 1 AND a.pos = b.pos AND a.pos <> ''),
word_list AS (SELECT pos, word, ('0x' || substr(md5(word), 1, 13))::BIGINT AS id FROM _listable GROUP BY pos, word HAVING count(*) >= 3)""",
    "links": r"""
_vec AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS vec FROM embeddings),
_tv AS (SELECT row_pos, side, idx, ('0x' || substr(md5(lower(word)), 1, 6))::BIGINT % (SELECT count(*) FROM embeddings) AS vid FROM tokens),
_pairs AS (SELECT a.row_pos, a.idx AS i, b.idx AS j, a.vid AS v1, b.vid AS v2
  FROM _tv a JOIN _tv b ON a.row_pos = b.row_pos AND a.side = 1 AND b.side = 2),
_once AS (SELECT k.v1, k.v2, list_dot_product(a.vec, b.vec)::BIGINT AS dot
  FROM (SELECT DISTINCT v1, v2 FROM _pairs) k JOIN _vec a ON a.vec_id = k.v1 JOIN _vec b ON b.vec_id = k.v2),
dots AS (SELECT row_pos, i, j, dot FROM _pairs JOIN _once USING (v1, v2)),
_e AS (SELECT *, exp((dot - max(dot) OVER (PARTITION BY row_pos, i)) * (10.0::DOUBLE / 65536)) AS ei,
  exp((dot - max(dot) OVER (PARTITION BY row_pos, j)) * (10.0::DOUBLE / 65536)) AS ej FROM dots),
probs AS (SELECT row_pos, i, j, dot, ei / sum(ei) OVER (PARTITION BY row_pos, i) AS p1, ej / sum(ej) OVER (PARTITION BY row_pos, j) AS p2 FROM _e),
links AS (SELECT row_pos, i, j FROM probs WHERE p1 > 0.2 AND p2 > 0.2)""",
    "groups": r"""
_first AS (SELECT row_pos, i, min(j) AS fj FROM links GROUP BY row_pos, i),
_owner AS (SELECT row_pos, j, min(i) AS oi FROM links GROUP BY row_pos, j),
_parent AS (SELECT f.row_pos, f.i, o.oi AS parent FROM _first f JOIN _owner o ON f.row_pos = o.row_pos AND f.fj = o.j),
_root AS (
  WITH RECURSIVE climb AS (
    SELECT row_pos, i, parent FROM _parent
    UNION ALL SELECT c.row_pos, c.i, p.parent FROM climb c JOIN _parent p ON c.row_pos = p.row_pos AND c.parent = p.i WHERE p.parent <> p.i)
  SELECT row_pos, i, min(parent) AS root FROM climb GROUP BY row_pos, i),
members AS (
  SELECT row_pos, root AS g, 1 AS side, i AS idx FROM _root
  UNION ALL SELECT o.row_pos, r.root, 2, o.j FROM _owner o JOIN _root r ON o.row_pos = r.row_pos AND o.oi = r.i)""",
    "kept_groups": r"""
_ignored AS (
  SELECT row_pos, side, idx + 1 AS idx FROM tokens WHERE side = 1 AND word IN ('is', 'of')
  UNION ALL SELECT row_pos, side, idx + 1 FROM tokens WHERE side = 2 AND word = 'to'
  UNION ALL SELECT row_pos, side, idx - 1 FROM tokens WHERE side = 2 AND word = 'de'
  UNION ALL SELECT a.row_pos, a.side, a.idx FROM tokens a JOIN tokens b ON a.row_pos = b.row_pos AND a.side = 1 AND b.side = 1 AND b.idx = a.idx + 1
    WHERE a.word IN ('is', 'are', 'was', 'were', 'am', 'be', 'been', 'being') AND b.pos = 'v'),
_touched AS (SELECT DISTINCT m.row_pos, m.g FROM members m JOIN _ignored x ON m.row_pos = x.row_pos AND m.side = x.side AND m.idx = x.idx),
kept AS (SELECT m.*, t.word, t.pos FROM members m JOIN tokens t ON m.row_pos = t.row_pos AND m.side = t.side AND m.idx = t.idx
  ANTI JOIN _touched x ON m.row_pos = x.row_pos AND m.g = x.g)""",
    "elements": r"""
_span AS (SELECT *, count(*) FILTER (pos <> '') OVER w AS n, min(CASE WHEN pos <> '' THEN idx END) OVER w AS a, max(CASE WHEN pos <> '' THEN idx END) OVER w AS b
  FROM kept WINDOW w AS (PARTITION BY row_pos, g, side)),
_spot AS (SELECT *, CASE WHEN n > 1 AND idx BETWEEN a AND b THEN a ELSE idx END AS spot FROM _span),
elements AS (SELECT row_pos, g, side, string_agg(word, ' ' ORDER BY idx) AS word, coalesce(string_agg(pos, '/' ORDER BY idx) FILTER (pos <> ''), '') AS pos,
  row_number() OVER (PARTITION BY row_pos, g, side ORDER BY spot) - 1 AS k FROM _spot GROUP BY row_pos, g, side, spot),
_codes AS (SELECT DISTINCT row_pos, g, side, pos FROM kept WHERE pos <> ''),
codes AS (SELECT a.row_pos, a.g, a.pos FROM _codes a JOIN _codes b ON a.row_pos = b.row_pos AND a.g = b.g AND a.pos = b.pos AND a.side = 1 AND b.side = 2)""",
    "heads": r"""
_usable AS (SELECT e.* FROM elements e SEMI JOIN codes c ON e.row_pos = c.row_pos AND e.g = c.g),
_head AS (SELECT * FROM _usable WHERE pos <> ''),
_other AS (SELECT * FROM _usable WHERE pos = '')""",
    "candidates": r"""
_chosen AS (
  SELECT row_pos, g, side, [{'k': k, 'w': word}] AS e FROM _head
  UNION ALL SELECT h.row_pos, h.g, h.side, list_sort([{'k': h.k, 'w': h.word}, {'k': x.k, 'w': x.word}])
  FROM _head h JOIN _other x ON h.row_pos = x.row_pos AND h.g = x.g AND h.side = x.side
  UNION ALL SELECT h.row_pos, h.g, h.side, list_sort([{'k': h.k, 'w': h.word}, {'k': x.k, 'w': x.word}, {'k': y.k, 'w': y.word}])
  FROM _head h JOIN _other x ON h.row_pos = x.row_pos AND h.g = x.g AND h.side = x.side JOIN _other y ON h.row_pos = y.row_pos AND h.g = y.g AND h.side = y.side AND y.k > x.k),
_listed_as AS (SELECT row_pos, g, side, list_transform(e, lambda x: x.k) AS idx, array_to_string(list_transform(e, lambda x: x.w), ' ') AS phrase FROM _chosen),
candidates AS (SELECT *, row_number() OVER (PARTITION BY row_pos, g, side ORDER BY len(idx) DESC, idx) - 1 AS place,
  CASE WHEN length(regexp_replace(lower(phrase), '(ing|en|ed|es|s)$', '')) >= 3 THEN regexp_replace(lower(phrase), '(ing|en|ed|es|s)$', '') ELSE lower(phrase) END AS norm FROM _listed_as)""",
    "facts": r"""
_hits AS (SELECT x.row_pos, x.g, x.side, x.place, x.phrase, x.norm, c.pos, l.id FROM candidates x JOIN codes c ON x.row_pos = c.row_pos AND x.g = c.g JOIN word_list l ON l.pos = c.pos AND l.word = x.norm),
matches AS (SELECT * FROM _hits QUALIFY place = min(place) OVER (PARTITION BY row_pos, g, side)),
_exceptions AS (SELECT DISTINCT a.lemma AS norm1, b.lemma AS norm2 FROM links k JOIN tokens a ON a.row_pos = k.row_pos AND a.side = 1 AND a.idx = k.i
  JOIN tokens b ON b.row_pos = k.row_pos AND b.side = 2 AND b.idx = k.j WHERE substr(md5(a.lemma || b.lemma), 1, 1) = '0'),
emitted AS (SELECT a.row_pos, a.g, a.pos, a.id AS id1, a.phrase AS word1, a.norm AS norm1, b.id AS id2, b.phrase AS word2, b.norm AS norm2
  FROM matches a JOIN matches b ON a.row_pos = b.row_pos AND a.g = b.g AND a.pos = b.pos AND a.side = 1 AND b.side = 2),
facts AS (SELECT *, row_number() OVER (PARTITION BY row_pos ORDER BY g, pos) - 1 AS seq, (row_pos // 1048576) || '-' || (row_pos % 1048576) AS id
  FROM emitted e ANTI JOIN _exceptions x ON e.norm1 = x.norm1 AND e.norm2 = x.norm2)""",
    "relations": r"""
_grouped AS (SELECT pos, id1, id2, count(*) AS count, list(id ORDER BY row_pos, seq) AS examples, min(row_pos * 1000000 + seq) AS first FROM facts GROUP BY pos, id1, id2),
relations AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY first, id1, id2) - 1 AS relation_id FROM _grouped)""",
}


def em_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_pos, id, w1, p1, w2, p2, links, groups: the corpus with links by expectation maximisation, without vectors."""
    from glossweave.operators.translation import em_links

    return em_links(tokenised(spark, sf_dir)[0].drop("n1", "n2"), EM_ROUNDS)


def _em_sql(rounds: int) -> str:
    """em0 .. the tables of each round, t, and links, from the words of both sides and the null word before side 1."""
    parts = [
        """_es AS (SELECT row_pos, idx AS i, lower(word) AS w FROM tokens WHERE side = 1 UNION ALL SELECT row_pos, -1, '' FROM corpus),
_eo AS (SELECT a.row_pos, a.i, b.idx AS j, a.w AS w1, lower(b.word) AS w2 FROM _es a JOIN tokens b ON b.row_pos = a.row_pos AND b.side = 2)"""
    ]
    for r in range(rounds):
        t, source = ("16777216", "_eo") if not r else ("t", f"_eo JOIN em{r - 1} USING (w1, w2)")
        parts.append(f"""_ec{r} AS (SELECT w1, w2, sum(c)::HUGEINT AS c FROM (SELECT w1, w2, {t}::HUGEINT * 65536 // sum({t}) OVER (PARTITION BY row_pos, j) AS c FROM {source}) GROUP BY w1, w2),
em{r} AS (SELECT w1, w2, greatest(1, c * 16777216 // greatest(1, sum(c) OVER (PARTITION BY w1)))::BIGINT AS t FROM _ec{r})""")
    parts.append(f"""em AS (SELECT * FROM em{rounds - 1}),
links AS (SELECT row_pos, i, j FROM (SELECT row_pos, j, arg_min(i, (-t, i)) AS i FROM _eo JOIN em USING (w1, w2) GROUP BY row_pos, j) WHERE i >= 0)""")
    return ",\n".join(parts)


#: Rounds of expectation maximisation in the queries.
EM_ROUNDS = 3
SQL["em"] = _em_sql(EM_ROUNDS)
