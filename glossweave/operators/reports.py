"""Texts for reviewers, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.functions.text import shown_tokens


def norm_changes(words: DataFrame) -> DataFrame:
    """word->norm of entries (pos, word, norm) whose form changes."""
    return words.where(F.col("word") != F.col("norm")).select("pos", F.concat("word", F.lit("->"), "norm").alias("line"))


def alignments(corpus: DataFrame, facts: DataFrame) -> DataFrame:
    """row_pos, s1, s2 and the line 'w1 - w2  ...' of its facts in order, empty without any."""
    line = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", F.concat("word1", F.lit(" - "), "word2").alias("x")))), lambda f: f["x"]), "  ")
    return corpus.select("row_pos", "s1", "s2").join(facts.groupBy("row_pos").agg(line.alias("line")), "row_pos", "left").withColumn("line", F.coalesce("line", F.lit("")))


def tags(rows: DataFrame) -> DataFrame:
    """row_pos and the line word:pos of toks."""
    return rows.select("row_pos", shown_tokens(F.col("toks")).alias("line"))
