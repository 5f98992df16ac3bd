"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import pytest
from pyspark.sql import functions as F

from glossweave.llm import bpe, common, media, mixing, neardup, pii, quality, repeats, secrets, token_files, topk

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
ROWS = [
    (1, None, "a", "en"),
    (2, "", "a", "en"),
    (3, " \n\t ", None, "en"),
    (4, LONG, "b", "fr"),
    (5, "Write to ann.b@mail.example.com or +1 (743) 555-3824, password=abcdef12345 'quoted' text", "b", None),
    (6, "the same words in the same order stand here twice", "c", "en"),
    (7, "the same words in the same order stand here twice", "c", "en"),
    (7, "the same words in the same order stand here twice", "c", "en"),
    (None, "a text without an id", None, None),
    (8, "Žluťoučký kůň 漢字 \u0085 é 😀", "c", "cs"),
]
#: Names that the operators use themselves.
CLASH = ["size", "th", "set", "n", "word", "block", "path_", "q", "u", "rank", "terms", "key", "value", "count"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string").withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASH:
        df = df.withColumn(name, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df):
    return df.collect()


def test_neardup(docs, none):
    got = rows(neardup.near_duplicates(docs))
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[1].kept and by[2].kept and by[3].kept
    assert by[7].component_id == 6 and not by[7].kept and by[6].kept and by[4].n_shingles > 977
    assert by[None].component_id is None and by[None].kept
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in rows(kept)) == sorted(["1", "2", "3", "4", "5", "6", "8", "None"])
    assert rows(neardup.near_duplicates(none)) == [] and rows(neardup.keep_one(none)) == []


def test_pii(docs, none):
    got = rows(pii.find(docs))
    assert len(got) == len(ROWS)
    assert [(s.kind, s.start) for r in got if r.doc_id == 5 for s in r.pii_spans] == [("email", 9), ("phone", 35)]
    assert all(not r.pii_spans for r in got if r.doc_id != 5)
    clean = {r.doc_id: r.text for r in rows(pii.redact(docs))}
    assert clean[5].startswith("Write to <email> or <phone>,") and clean[1] is None and clean[4] == LONG
    assert rows(pii.find(none)) == [] and rows(pii.redact(none)) == []


def test_repeats(docs, none):
    got = rows(repeats.remove_repeats(docs, keep=("doc_id", "size"), window=5, with_text=True))
    by = {r.doc_id: r for r in got}
    assert len(got) == len(ROWS) and by[1].n_words == by[2].n_words == by[3].n_words == 0
    assert by[6].n_words == by[7].n_removed == 10 and by[6].kept_text == "" and by[None].n_removed == 0
    assert by[4].n_words == 40_000 and by[4].n_removed > 0
    assert rows(repeats.remove_repeats(none)) == []


def test_bpe(docs, none):
    got = {r.doc_id: r for r in rows(bpe.decode(bpe.encode(docs, keep=("doc_id", "word", "block"))))}
    assert {k: r.decoded.decode() for k, r in got.items()} == {r[0]: r[1] or "" for r in ROWS}
    assert got[1].ids == [] and got[5].word == "x"
    assert rows(bpe.decode(bpe.encode(none))) == []


def test_quality(docs, none, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)] + [(None, 1), (4, None)], "doc_id long, quality int")
    got = rows(quality.score(docs, quality.train(docs, labels)))
    assert len(got) == len(ROWS) and all(0 <= r.quality_score <= 1 for r in got)
    assert len({r.quality_score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert quality.train(docs, labels.where("false")) is None
    assert {r.quality_score for r in rows(quality.score(docs, None))} == {0.5}
    assert rows(quality.score(none, None)) == []


def test_mixing(docs, none):
    got = rows(mixing.mix(docs))
    assert len(got) == len(ROWS) and all(0 <= r.mix_copies <= 2 for r in got)
    assert {r.mix_source_size for r in got if r.source is None} == {5}
    repeated = [r.mix_copies for r in got if r.doc_id == 7]
    assert repeated[0] == repeated[1]
    assert sorted(map(str, rows(mixing.mix(docs)))) == sorted(map(str, got))
    assert mixing.mixed(docs).columns == docs.columns
    assert rows(mixing.mix(none)) == [] and rows(mixing.mixed(none)) == []


def test_secrets(docs, none, spark):
    ledger = secrets.Ledger(spark, common.shared_dir(spark, "ledger"))
    versions = docs.withColumnRenamed("doc_id", "path")
    ledger.add(versions)
    got = rows(ledger.report(versions))
    assert len(got) == len(ROWS)
    assert [f.rule for r in got for f in r.found or ()] == ["assign"]
    before = ledger.scanned().count()
    ledger.add(versions)
    assert ledger.scanned().count() == before == 7 * len(secrets.RULES)
    # a new version of a rule is scanned over all blobs, and old findings of it no longer count
    newer = tuple((k, v + (k == "assign"), p.replace("password", "passphrase"), least, g) for k, v, p, least, g in secrets.RULES)
    ledger.add(versions, newer)
    assert ledger.scanned().count() == before + 7
    assert not any(r.found for r in rows(ledger.report(versions, newer)))
    assert rows(ledger.report(none.withColumnRenamed("doc_id", "path"))) == []


def test_topk(spark):
    data = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (100, []), (7, [-1.0, 0.0])]
    got = [tuple(r) for r in topk.search(spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("v", F.lit(2))).orderBy("query_id", "rank").collect()]
    # the two rows of query 50 share its places
    assert got[:5] == [(50, 1, 1, 65536), (50, 2, 1, 65536), (50, 3, 2, 65536), (50, 4, 2, 65536), (50, 5, 3, 32768)]
    assert got[5:] == [(100, i + 1, k, 0) for i, k in enumerate((1, 2, 3, 7, 50))]
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_token_files(docs, none, spark):
    shards = token_files.write_shards(docs, common.shared_dir(spark, "tokens"), shard_tokens=64)
    got = sorted(rows(token_files.read_shards(shards)), key=lambda r: r.start)
    assert len(got) == len(ROWS) and got[0].doc_id is None and [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
    assert len(next(r for r in got if r.doc_id == 1).ids) == 4
    assert rows(token_files.read_shards(token_files.write_shards(none, common.shared_dir(spark, "tokens")))) == []


def test_media(docs, none, spark):
    folder = common.shared_dir(spark, "media")
    media.write_archives(docs, folder, archive_bytes=2000)
    got = rows(media.measure(media.read_archives(spark, folder, rangeBytes=500).select("doc_id", "media")))
    assert sorted((str(r.doc_id), r.n_bytes) for r in got) == sorted((str(r[0]), len((r[1] or "").encode())) for r in ROWS)
    assert {r.payload_bytes % 576 for r in got} == {0} and min(r.payload_bytes for r in got) == 576
    empty = common.shared_dir(spark, "media")
    media.write_archives(none, empty)
    assert media.read_archives(spark, empty).count() == 0
