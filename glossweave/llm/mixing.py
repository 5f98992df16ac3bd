"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words. Within a source documents are not equally likely: a document weighs as many as its size in words has digits
(or what a weight column says), and is expected r = min(most, c * weight) times, with the c of its source at which the expected words come
to the target. floor(r) copies of it are certain; for the rest, f = r - floor(r), documents are ranked by their Pareto
variable q = [u / (1 - u)] / [f / (1 - f)], random odds by inclusion odds, and the ranking is cut where the
words taken come nearest to what is still missing. u is a hash of the row, so reruns agree.

Nothing is ordered as a whole. c comes from sums over (source, weight), filled in the same way as the sources' targets. q is mapped to [0, 1) and
counted in `bins` bins for each source; the bin that
holds the cut is found from these sums, and only that bin's documents are ordered. Documents then
compare their q with their source's cut: one join with a table that has one row for each source.

Rows. Null or empty texts have size 0 and are taken 0 words. A null source is a source of its own, last in
order. A null doc_id is like any other value. A null or negative weight is 0: the document is never taken. Repeated rows (same id and text) share u, so all or none of
them get the sampled copy. An empty table gives no rows. Other columns pass through; those with the name of an output column give way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.common import WORD, materialise, text_or_empty, unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BINS = 4096
OUTPUTS = ("mix_size", "mix_source_size", "mix_target", "mix_copies")
#: Rows of the table of sources up to which it is broadcast; beyond, Spark joins by a shuffle.
BROADCAST_SOURCES = 20_000


def word_count():
    return F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")


def uniform(seed: int = 0):
    """A number in (0, 1) from the row's id and text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(text_or_empty()))
    return (F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def filled(sizes: DataFrame, goal, group: list[str], order: list[str], most: float = MOST) -> DataFrame:
    """sizes (size, weight) with target = min(most * size, level * weight), where targets add up to `goal`, a column, in each group.

    This is what sharing the excess of full rows by weight again and again ends in. Rows are ordered by the level at which
    they are full; with the first k full, the level is what is left by the weights left, and the first at which the next row is not full counts.
    """
    full_first = Window.partitionBy(*group).orderBy((F.col("size") / F.col("weight")).asc(), *order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*group)
    ranked = sizes.withColumn("size_before", F.coalesce(F.sum("size").over(full_first), F.lit(0))).withColumn("weight_before", F.coalesce(F.sum("weight").over(full_first), F.lit(0)))
    left = goal - F.lit(most) * F.col("size_before")
    ranked = ranked.withColumn("c", left / (F.sum("weight").over(everything) - F.col("weight_before")))
    # the row is not full at its own c: then that c holds for it and for all after it
    open_here = F.col("c") * F.col("weight") <= F.lit(most) * F.col("size")
    ranked = ranked.withColumn("level", F.min(F.when(open_here, F.struct("weight_before", "c"))).over(everything)["c"])
    full = F.lit(most) * F.col("size")
    return ranked.withColumn("target", F.coalesce(F.least(full, F.col("level") * F.col("weight")), full)).drop("size_before", "weight_before", "c")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target of the sources in sizes (source, source_size): their share of all sizes by weight. A row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    picks = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", F.element_at(picks, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    goal = F.lit(share) * F.sum("size").over(Window.partitionBy())
    return filled(ranked.withColumnRenamed("source_size", "size"), goal, [], ["place"], most).select("source", F.col("size").alias("source_size"), "target")


def with_source(left: DataFrame, right: DataFrame, few: bool) -> DataFrame:
    """left with the columns of right, which has a row for each source."""
    (name,) = unused(left, "s")
    right = right.withColumnRenamed("source", name)
    return left.join(F.broadcast(right) if few else right, left["source"].eqNullSafe(right[name]), "left").drop(name)


def _drawn(weight, level, u, most: float):
    """(whole copies, Pareto variable or null) of a document; without a level its source is full."""
    expected = F.when(weight > 0, F.coalesce(F.least(F.lit(float(most)), level * weight), F.lit(float(most)))).otherwise(F.lit(0.0))
    whole, part = F.floor(expected), expected - F.floor(expected)
    odds = (u / (1 - u)) / (part / (1 - part))
    return whole.cast("long"), F.when(part > 0, odds / (1 + odds))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, bins: int = BINS, weight_col: str | None = None, seed: int = 0) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies (whole copies the mix takes)."""
    # the words are counted once; the weight follows from their number
    weighing = lambda n: F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight_col else F.length(F.col(n).cast("string")).cast("double")
    u, w, s, n, level, cut, below = unused(docs, "u", "w", "s", "n", "level", "cut", "below")
    counted = docs.withColumns({n: word_count(), u: uniform(seed)})
    sized = materialise(counted.select("source", F.col(n).alias("size"), F.col(u).alias("u"), weighing(n).alias("weight")), "mix-sizes")
    # documents of one source and weight fill alike; there are few weights, unless a column gives many
    classes = materialise(sized.groupBy("source", "weight").agg(F.sum("size").alias("size")), "mix-classes")
    targets = source_targets(classes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    weighed = classes.where("weight > 0 AND size > 0").withColumnRenamed("weight", "of")
    weighed = with_source(weighed, targets.select("source", F.col("target").alias("goal")), few).withColumn("weight", F.col("size") * F.col("of"))
    levels = filled(weighed, F.col("goal"), ["source"], ["of"], most).groupBy("source").agg(F.min("level").alias("level"))
    plan = materialise(with_source(targets, levels, False), "mix-plan")

    whole, q = _drawn(F.col("weight"), F.col("level"), F.col("u"), most)
    ranked = with_source(sized, plan, few).withColumn("whole", whole).withColumn("q", q)
    missing = ranked.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("whole")).alias("certain"))
    missing = missing.select("source", (F.col("target") - F.col("certain")).alias("missing"))
    binned = ranked.where("q IS NOT NULL").withColumn("bin", F.least(F.floor(F.col("q") * bins), F.lit(bins - 1)))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("words")).withColumn("to", F.sum("words").over(running))
    sums = with_source(sums, missing, False)
    # the bin in which the words reach what is missing; if none does, the last one
    reached = F.min(F.when(F.col("to") >= F.col("missing"), F.struct("bin", (F.col("to") - F.col("words")).alias("before"), "missing")))
    last = F.max(F.struct("bin", (F.col("to") - F.col("words")).alias("before"), "missing"))
    cut_bin = sums.groupBy("source").agg(F.coalesce(reached, last).alias("cut")).select("source", F.col("cut.bin").alias("cut_bin"), F.col("cut.before").alias("before"), F.col("cut.missing").alias("missing"))
    inside = with_source(binned.select("source", "bin", "q", "size"), cut_bin, few).where("bin = cut_bin")
    ordered = Window.partitionBy("source").orderBy("q").rangeBetween(Window.unboundedPreceding, 0)
    near = inside.groupBy("source", "q").agg(F.sum("size").alias("size"), F.first("before").alias("before"), F.first("missing").alias("missing"), F.first("cut_bin").alias("cut_bin"))
    near = near.withColumn("to", F.col("before") + F.sum("size").over(ordered))
    # the cut nearest to what is missing; none of the bin is a choice too
    best = near.groupBy("source").agg(F.min(F.struct(F.abs(F.col("to") - F.col("missing")).alias("off"), F.col("q"))).alias("best"), F.first("cut_bin").alias("cut_bin"), F.min(F.abs(F.col("before") - F.col("missing"))).alias("off_none"))
    nearest = F.when(F.col("off_none") <= F.col("best.off"), F.col("cut_bin") / F.lit(float(bins))).otherwise(F.col("best.q"))
    cuts = best.select("source", nearest.alias("cut"), (F.col("off_none") <= F.col("best.off")).alias("below"))
    cuts = materialise(with_source(plan, cuts, False), "mix-cuts")

    # a weight column may have the name of an output column, so it is read before these take their places
    decided = counted.withColumn(w, weighing(n)).drop(*OUTPUTS).withColumnRenamed(n, "mix_size")
    cuts = cuts.select(F.col("source").alias(s), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("level").alias(level), F.col("cut").alias(cut), F.col("below").alias(below))
    decided = decided.join(F.broadcast(cuts) if few else cuts, decided["source"].eqNullSafe(cuts[s]), "left")
    whole, q = _drawn(F.col(w), F.col(level), F.col(u), most)
    chosen = F.when(F.col(below), q < F.col(cut)).otherwise(q <= F.col(cut))
    copies = whole + F.when(F.coalesce(chosen, F.lit(False)), 1).otherwise(0)
    return decided.withColumn("mix_copies", copies).drop(s, u, w, level, cut, below)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as its copies say, with the columns of docs."""
    clash = {c.lower() for c in docs.columns} & set(OUTPUTS)
    held, copy = unused(docs, "held", "copy")
    whole = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias(held)) if clash else docs
    taken = mix(whole, **options).where("mix_copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return taken.select(f"{held}.*") if clash else taken.select(*docs.columns)


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    from glossweave.llm.common import read_table

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mix(docs)
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").cast("double").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"))
