"""From facts to relations: counts, examples, ids, and what is built on earlier totals.

Facts: row_pos, seq (order within the row), id (of the corpus row), pos, id1, id2. The one large shuffle groups them by
(pos, id1, id2), which Spark sums before it shuffles. Examples stay rows, one for each fact, wherever a job can take them so;
where a table must hold them as arrays, those of frequent relations are first gathered by salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.config import NEW_WORD_COUNTS
from glossweave.plans.storage import lookup, numbered, stored

KEY = ["pos", "id1", "id2"]
#: Groups in which a relation's examples are first gathered.
SALT = 32


def count_relations(facts: DataFrame) -> DataFrame:
    """pos, id1, id2, count: each fact counts."""
    return facts.groupBy(*KEY).agg(F.count("*").alias("count"))


def relation_totals(facts: DataFrame) -> DataFrame:
    """pos, id1, id2, count and first, the first fact's (row_pos, seq): no relation's facts meet."""
    return facts.groupBy(*KEY).agg(F.count("*").alias("count"), F.min(F.struct("row_pos", "seq")).alias("first"))


def collect_examples(facts: DataFrame) -> DataFrame:
    """With examples, the corpus ids in order of the rows, and first, the first fact's (row_pos, seq)."""
    some = facts.groupBy(*KEY, F.pmod(F.xxhash64("row_pos"), F.lit(SALT)).alias("_salt")).agg(F.count("*").alias("count"), F.collect_list(F.struct("row_pos", "seq", "id")).alias("seen"))
    whole = some.groupBy(*KEY).agg(F.sum("count").alias("count"), F.sort_array(F.flatten(F.collect_list("seen"))).alias("seen"))
    first = F.struct(F.col("seen")[0]["row_pos"].alias("row_pos"), F.col("seen")[0]["seq"].alias("seq"))
    return whole.select(*KEY, "count", F.transform("seen", lambda x: x["id"]).alias("examples"), first.alias("first"))


def relation_ids(relations: DataFrame, offset: DataFrame | None = None) -> DataFrame:
    """relations with relation_id from 0 in order of `first` within each pos; offset (pos, next_id) says where to begin.

    Only the keys are sorted and numbered; what else a relation has, as its examples, is joined again.
    """
    relations = stored(relations, "relations")
    keys = relations.select(*KEY, F.col("first.row_pos").alias("_row"), F.col("first.seq").alias("_seq"))
    ids = numbered(keys, ["pos"], ["_row", "_seq", "id1", "id2"], "relation_id").drop("_row", "_seq")
    out = lookup(relations, ids, KEY, "inner")
    if offset is not None:
        out = out.join(F.broadcast(offset), "pos", "left").withColumn("relation_id", F.col("relation_id") + F.coalesce("next_id", F.lit(0))).drop("next_id")
    return out


def relation_backjoin(facts: DataFrame, relations: DataFrame) -> DataFrame:
    """Each fact with its relation's id."""
    return lookup(facts, relations.select(*KEY, "relation_id"), KEY, "inner")


def example_rows(facts: DataFrame, relations: DataFrame) -> DataFrame:
    """Each fact as a row of its relation: relation_id, pos, row_pos, seq, id. A hot relation is many rows, not one long array."""
    return relation_backjoin(facts, relations).select("relation_id", "pos", "row_pos", "seq", "id")


def with_examples(totals: DataFrame, rows: DataFrame) -> DataFrame:
    """totals (relation_id, KEY, count) with the arrays of their example rows, in order of the rows."""
    some = rows.groupBy("pos", "relation_id", F.pmod(F.xxhash64("row_pos"), F.lit(SALT)).alias("_salt")).agg(F.collect_list(F.struct("row_pos", "seq", "id")).alias("seen"))
    seen = some.groupBy("pos", "relation_id").agg(F.sort_array(F.flatten(F.collect_list("seen"))).alias("seen"))
    empty = F.array().cast("array<string>")
    out = totals.join(seen, ["pos", "relation_id"], "left").withColumn("examples", F.coalesce(F.transform("seen", lambda x: x["id"]), empty))
    return out.select("relation_id", *KEY, "count", "examples")


def relation_defaults(relations: DataFrame) -> DataFrame:
    return relations.withColumn("convert_from", F.lit("unknown")).withColumn("invalid", F.lit(False))


def merge_relations(old: DataFrame, facts: DataFrame) -> DataFrame:
    """Earlier relations (relation_id, KEY, count, examples) and the facts of later rows as one.

    What was there keeps its id and grows; new relations are numbered after the highest id of their pos.
    """
    new = collect_examples(facts)
    renamed = new.select(*KEY, F.col("count").alias("_n"), F.col("examples").alias("_x"))
    grown = old.join(renamed, KEY, "left")
    grown = grown.select("relation_id", *KEY, (F.col("count") + F.coalesce("_n", F.lit(0))).alias("count"), F.concat("examples", F.coalesce("_x", F.array().cast("array<string>"))).alias("examples"))
    offset = old.groupBy("pos").agg((F.max("relation_id") + 1).alias("next_id"))
    added = relation_ids(new.join(old.select(*KEY), KEY, "left_anti"), offset)
    return grown.unionByName(added.select("relation_id", *KEY, "count", "examples"))


def word_totals(tokens: DataFrame) -> DataFrame:
    """word, count and first of tokens (row_pos, idx, word), so that what is made of a word is made once for each distinct one. Stored, as a filter on a code would else be pushed to the tokens."""
    return stored(tokens.groupBy("word").agg(F.count("*").alias("count"), F.min(F.struct("row_pos", "idx")).alias("first")), "word-totals")


def token_counts(words: DataFrame, listed: DataFrame) -> DataFrame:
    """pos, word, count and first of words (row_pos, idx, pos, word, or as word_totals gives them) that are content words and not listed (pos, word)."""
    totals = words if "first" in words.columns else words.select("pos", "word", F.lit(1).alias("count"), F.struct("row_pos", "idx").alias("first"))
    counted = totals.where("pos <> ''").groupBy("pos", "word").agg(F.sum("count").cast("long").alias("count"), F.min("first").alias("first"))
    return lookup(counted, listed.select("pos", "word").distinct(), ["pos", "word"], "left_anti")


def new_wordlist(counts: DataFrame, least: dict[str, int] = NEW_WORD_COUNTS, compat: bool = False) -> DataFrame:
    """pos, word, id for words that are there often enough, numbered in order of first sight (compat: all 0)."""
    enough = F.lit(False)
    for code, n in least.items():
        enough = enough | ((F.col("pos") == code) & (F.col("count") >= n))
    kept = counts.where(enough).withColumn("_row", F.col("first.row_pos")).withColumn("_idx", F.col("first.idx"))
    if compat:
        return kept.select("pos", "word", F.lit(0).cast("long").alias("id"))
    return numbered(kept, ["pos"], ["_row", "_idx", "word"], "id").select("pos", "word", "id")


def wordlist_closure(words: DataFrame, compat: bool = False) -> DataFrame:
    """New entries (pos, word, id) for normalised forms that are not listed.

    words: pos, word, id, norm. Sources count in order of id, then word. Ids go on from the highest: dense in order of the
    first source, or (compat) one for each source, of which a form keeps the last.
    """
    listed = words.select(F.col("pos"), F.col("word").alias("norm")).distinct()
    missing = words.join(listed, ["pos", "norm"], "left_anti")
    highest = words.groupBy("pos").agg(F.max("id").alias("top"))
    placed = numbered(missing, ["pos"], ["id", "word"], "place")
    if compat:
        forms = placed.groupBy("pos", "norm").agg(F.max("place").alias("place"))
    else:
        first = placed.groupBy("pos", "norm").agg(F.min("place").alias("at"))
        forms = numbered(first, ["pos"], ["at"], "place").drop("at")
    return forms.join(F.broadcast(highest), "pos").select("pos", F.col("norm").alias("word"), (F.col("top") + 1 + F.col("place")).alias("id"))


def id_lookup(words: DataFrame, listed: DataFrame) -> DataFrame:
    """words (pos, norm) with the id of the normalised form, null where it is not listed."""
    return lookup(words, listed.select("pos", F.col("word").alias("norm"), "id"), ["pos", "norm"])


def max_id(listed: DataFrame) -> DataFrame:
    return listed.groupBy("pos").agg(F.max("id").alias("max_id"))


def enriched(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Corpus rows with commands: array of (pos, relation_id, id1, word1, id2, word2) in order; rows without facts have none."""
    found = facts.groupBy("row_pos").agg(F.sort_array(F.collect_list(F.struct("seq", "pos", "relation_id", "id1", "word1", "id2", "word2"))).alias("commands"))
    return rows.drop("commands").join(found, "row_pos", "left").withColumn("commands", F.coalesce("commands", F.array().cast("array<struct<seq:int,pos:string,relation_id:bigint,id1:bigint,word1:string,id2:bigint,word2:string>>")))


def fact_order(facts: DataFrame) -> DataFrame:
    """facts with seq, their order within a row: by group, then code."""
    return facts.withColumn("seq", F.row_number().over(Window.partitionBy("row_pos").orderBy("g", "pos")) - 1)
