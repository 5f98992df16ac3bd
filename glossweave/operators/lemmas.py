"""Lemmas of words that no table lists: rules that replace a suffix, mined from the pairs that are listed.

A listed word and its lemma agree up to a place; what comes after it is cut and replaced. Every suffix that holds the cut, of up to CONTEXT characters more, is a
rule for it. A part of speech and suffix keep the replacement that most pairs have, if SUPPORT have it. A word takes the rule of its longest suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.plans.storage import lookup, stored

CONTEXT, SUPPORT = 3, 2


def _right(c: Column, n: Column) -> Column:
    return F.when(n > 0, F.substring(c, F.length(c) - n + 1, n)).otherwise("")


def mined_rules(lemmas: DataFrame, context: int = CONTEXT, support: int = SUPPORT) -> DataFrame:
    """pos, suffix, cut (characters that go), added, pairs (how many have it) from pos, word, lemma. Of equal counts the smaller cut, then the lesser text."""
    known = lemmas.where("pos IS NOT NULL AND word <> '' AND lemma IS NOT NULL").select("pos", "word", "lemma").distinct()
    short = F.least(F.length("word"), F.length("lemma"))
    agree = F.size(F.filter(F.sequence(F.lit(0), short), lambda k: F.substring(F.col("word"), F.lit(1), k) == F.substring(F.col("lemma"), F.lit(1), k))) - 1
    cut = known.withColumn("_agree", agree).select("pos", "word", (F.length("word") - F.col("_agree")).alias("cut"), F.substring(F.col("lemma"), F.col("_agree") + 1, F.length("lemma")).alias("added"))
    each = cut.withColumn("n", F.explode(F.sequence(F.col("cut"), F.least(F.length("word"), F.col("cut") + context))))
    counted = each.groupBy("pos", _right(F.col("word"), F.col("n")).alias("suffix"), "cut", "added").agg(F.count("*").alias("pairs")).where(F.col("pairs") >= support)
    best = counted.groupBy("pos", "suffix").agg(F.min(F.struct(-F.col("pairs"), "cut", "added")).alias("x"))
    return best.select("pos", "suffix", "x.cut", "x.added", (-F.col("x.col1")).alias("pairs"))


def lemmas_by_rule(words: DataFrame, rules: DataFrame) -> DataFrame:
    """pos, word, lemma for the distinct words (pos, word); a word that no rule fits is its own lemma."""
    rules = stored(rules, "lemma-rules")
    longest = rules.agg(F.coalesce(F.max(F.length("suffix")), F.lit(0))).first()[0]
    each = stored(words.select("pos", "word").distinct(), "lemma-words")
    cut = each.withColumn("n", F.explode(F.sequence(F.lit(0), F.least(F.length("word"), F.lit(longest))))).withColumn("suffix", _right(F.col("word"), F.col("n")))
    fits = lookup(cut, rules, ["pos", "suffix"], "inner").groupBy("pos", "word").agg(F.max(F.struct("n", "cut", "added")).alias("x"))
    made = fits.select("pos", "word", F.concat(F.substring(F.col("word"), F.lit(1), F.length("word") - F.col("x.cut")), F.col("x.added")).alias("lemma"))
    return each.join(made, ["pos", "word"], "left").withColumn("lemma", F.coalesce("lemma", "word"))
