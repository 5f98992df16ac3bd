"""Joins with a large lookup table over words of which a few are very frequent."""

import random

import pytest
from pyspark.sql import functions as F

from glossweave.operators import count as ct
from glossweave.plans import storage


@pytest.fixture(scope="module")
def zipf(spark):
    """Half of the places hold one word, and the others words by Zipf's law; null words too."""
    u = F.rand(7)
    word = F.when(u < 0.5, F.lit(1)).when(u < 0.52, F.lit(None)).otherwise(F.floor(F.pow(F.lit(50_000.0), F.rand(8)))).cast("long")
    rows = spark.range(0, 300_000, 1, 6).select(F.col("id").alias("at"), F.concat(F.lit("w"), word).alias("word"), F.lit("n").alias("pos"))
    return storage.stored(rows, "zipf")


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(0, 50_000).where("id % 3 <> 2").select(F.concat(F.lit("w"), "id").alias("word"), F.lit("n").alias("pos"), F.col("id").alias("tag"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_split_join_equals_join(spark, zipf, table, how, monkeypatch):
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 1 << 16)
    got = storage.lookup(zipf, table, ["pos", "word"], how)
    plain = zipf.join(table, ["pos", "word"], how)
    assert got.columns == plain.columns
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    assert mark(got) == mark(plain)


def test_no_task_gets_a_hot_word(spark, zipf, table, monkeypatch):
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 1 << 16)
    for name, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.shuffle.partitions", "12"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(name, value)
    try:
        sizes = lambda df: sorted(r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect())
        words = zipf.where("word IS NOT NULL")
        plain, split = sizes(words.join(table, ["pos", "word"])), sizes(storage.lookup(words, table, ["pos", "word"], "inner"))
        assert plain[-1] > 5 * plain[len(plain) // 2]
        # the parts of the scan, where hot words stay, and those of the shuffle
        shuffled = sizes(words.where(~F.col("word").isin("w1", *[f"w{i}" for i in range(2, 60)])).join(table, ["pos", "word"]))
        assert split[-1] <= max(2 * shuffled[len(shuffled) // 2], 1.2 * zipf.count() / 6)
        rest = [n for n in split if n < 0.5 * zipf.count() / 6]
        assert len(rest) >= 12 - 2 and rest[-1] <= 2 * rest[len(rest) // 2]
    finally:
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_summary_finds_what_is_hot(spark):
    rng = random.Random(2)
    rows = [(rng.choice([5, 5, 5, 6, *range(100, 140)]),) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k long").repartition(5)
    hashes = {r.h: r.k for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    found = {hashes[h] for h in storage.hot_hashes(df, F.xxhash64("k"), 4)}
    assert 5 in found and len(found) <= 16
    assert storage.hot_hashes(df.where("false"), F.xxhash64("k"), 4) == []


def test_a_hot_relation_finds_its_id(spark, monkeypatch):
    facts = spark.range(0, 20_000).select(F.col("id").alias("row_pos"), F.lit(0).alias("seq"), F.col("id").cast("string").alias("id"), F.lit("n").alias("pos"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("long").alias("id1"), F.lit(1).cast("long").alias("id2"))
    relations = storage.stored(ct.relation_ids(ct.relation_totals(facts)), "relations")
    expected = sorted(map(tuple, ct.example_rows(facts, relations).collect()))
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, ct.example_rows(facts, relations).collect())) == expected
