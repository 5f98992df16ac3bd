"""What the queries return against plain restatements, and columns that are called as the operators' own."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossweave.llm import bpe, common, mixing, neardup, pii, quality, repeats, secrets, token_files

SF = "/root/testdata/sf0.001"
OUTPUTS = ["quality_score", "pii_spans", "found", "mix_size", "mix_copies", "mix_source_size", "mix_target", "ids", "decoded"]
OWN = ["_s", "_u", "_cut", "_level", "_id", "_th", "_key", "_hash", "_row", "_terms", "_salt", "_deal", "_blob", "s", "u", "w", "level", "cut", "below", "id", "th", "key", "hash", "row", "terms", "salt", "deal", "blob", "held", "copy", "place", "text_2"]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in common.read_table(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def named(spark):
    rows = [(i, f"mail me at ann{i % 3}@x.example.com or password=abcdef{i % 2}12345 the same few words stand here and there", "ab"[i % 2]) for i in range(12)]
    df = spark.createDataFrame([*rows, (None, None, None)], "doc_id long, text string, source string")
    return df.withColumns({c: F.lit(f"mine {c}") for c in OUTPUTS + OWN})


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_columns_of_the_callers(spark, named):
    others = [c for c in named.columns if c not in OUTPUTS]
    mine = {c: f"mine {c}" for c in OWN}

    def holds(df, gone=()):
        rows = df.collect()
        assert rows and all(r[c] == v for r in rows for c, v in mine.items() if c in df.columns)
        assert set(others) | (set(OUTPUTS) - set(gone)) <= set(df.columns)
        return rows

    assert all(r.quality_score == 0.5 for r in holds(quality.score(named, None)))
    assert all(isinstance(r.pii_spans, list) for r in holds(pii.find(named)))
    assert all(r.pii_spans == "mine pii_spans" for r in holds(pii.redact(named)))
    assert all(r.mix_copies in (0, 1, 2) for r in holds(mixing.mix(named)))
    assert all(r.mix_copies == "mine mix_copies" for r in holds(mixing.mixed(named)))
    assert mixing.mixed(named).columns == named.columns and neardup.keep_one(named).columns == named.columns
    holds(neardup.keep_one(named))
    ledger = secrets.Ledger(spark, common.shared_dir(spark, "ledger"))
    versions = named.withColumnRenamed("doc_id", "path")
    ledger.add(versions)
    report = ledger.report(versions).collect()
    assert len(report) == 13 and sum(len(r.found or ()) for r in report) == 12 and all(r._key == "mine _key" for r in report)
    got = bpe.decode(bpe.encode(named, keep=named.columns))
    assert all((r.decoded.decode(), r.th) == (r.text or "", "mine th") for r in got.collect())


def test_personal_data_query(spark, texts):
    for r in pii.op3_pii(spark, SF).collect():
        base = pii.base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.BASE]
        shown = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == sha(shown) and r.spans.split(",")[: len(shown)] == (shown or [""])[: len(shown)]


def test_secrets_query(spark, texts):
    known = secrets.compiled(secrets.RULES)
    for r in secrets.op8_secrets(spark, SF).collect():
        found = sorted((a, i, b, k) for i, k in enumerate(secrets.BASE) for a, b in secrets.scan_text(texts[r.doc_id], *known[(k, 1)]))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(f[3] == k for f in found) for k in secrets.BASE]
        assert r.base_sha256 == sha([f"{k}:{a}:{b}" for a, _, b, k in found])


def test_byte_bpe_query(spark, texts):
    import public_tokenizers
    import tiktoken

    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in bpe.token_bytes(bpe.rank_file()).items()}, special_tokens={})
    got = bpe.op5_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = whole.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(map(str, ids)), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_token_files_query(spark, texts):
    from tokenizers import Tokenizer

    words, at = Tokenizer.from_file(token_files.tokenizer_file()), 0
    got = token_files.op10_token_files(spark, SF).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == sorted(texts)
    for r in got:
        ids = np.array([*words.encode(texts[r.doc_id], add_special_tokens=False).ids, token_files.END], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_quality_query(spark, texts):
    for r in quality.op6_quality(spark, SF).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_repeats_query(spark, texts):
    from collections import Counter

    docs = {k: re.findall(r"[^\x20\x09-\x0D]+", t) for k, t in texts.items()}
    seen = Counter(hash(tuple(d[i : i + 35])) for d in docs.values() for i in range(len(d) - 34))
    for r in repeats.op4_repeats(spark, SF).collect():
        d = docs[r.doc_id]
        gone = {j for i in range(len(d) - 34) if seen[hash(tuple(d[i : i + 35]))] > 1 for j in range(i, i + 35)}
        assert (r.n_words, r.n_removed) == (len(d), len(gone)) and r.kept_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(d) if i not in gone).encode()).hexdigest()


def test_mix_prefers_heavier_documents(spark):
    df = spark.createDataFrame([(i, "a", " ".join(["w"] * (3 if i % 2 else 300)), float(1 + 9 * (i % 2))) for i in range(400)] + [(i, "b", "w " * 3000, 1.0) for i in range(400, 420)], "doc_id long, source string, text string, weight double")
    mean = lambda out, odd: np.mean([r.mix_copies for r in out if r.source == "a" and r.doc_id % 2 == odd])
    for options, heavy in (({}, 0), ({"weight_col": "weight"}, 1)):
        out = mixing.mix(df, share=0.6, **options).collect()
        assert mean(out, heavy) >= mean(out, 1 - heavy) + 0.2
        for s in "ab":
            rows = [r for r in out if r.source == s]
            assert abs(sum(r.mix_copies * r.mix_size for r in rows) - rows[0].mix_target) <= max(r.mix_size for r in rows)


def test_terms_generalise_to_a_class(spark):
    """zanzibar stands by one address nearly always, words that begin alike stand everywhere."""
    docs = [(i, f"see zanzibar near ann@x.example.com now {i} and again zanzibar far") for i in range(20)]
    docs += [(20 + i, f"zanzibar alone {i}") for i in range(2)] + [(100 + i, f"zanzotto and more words {i}") for i in range(80)]
    clean = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(docs, "doc_id long, text string"), remove=0.99).collect()}
    # words that stand nowhere else, as near and far, are removed
    assert clean[0].split() == ["zanz*", "<email>", "0", "and", "zanz*"] and clean[20] == "zanzibar alone 0" and clean[100] == docs[22][1]


def test_pipeline_on_odd_rows(spark, tmp_path):
    import corpus_pipeline

    long = " ".join(f"word{i % 997} {'and then it went on.' if i % 9 == 0 else ''}" for i in range(20_000))
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, long, None, "a"), (4, long, "en", "b"), (4, long, "en", "b"), (None, "A text without an id. It has two lines.\nHere is the other.", None, None)]
    docs = spark.createDataFrame([*rows, *[(10 + i, f"Plain text number {i}. It says little, and ends.", "en", "ab"[i % 2]) for i in range(8)]], "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    labels = spark.createDataFrame([(10, 1), (11, 1), (3, 1), (4, 0), (None, 0)], "doc_id long, quality int")
    for name, some in (("all", docs), ("none", docs.where("false"))):
        sf = f"{tmp_path}/{name}"
        some.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        out = corpus_pipeline.run(spark, sf).collect()
        assert (not out) == (name == "none")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "None", *map(str, range(10, 18))])


def test_repeats_keep_columns_of_any_name(spark):
    words = " ".join(f"w{i}" for i in range(9))
    df = spark.createDataFrame([(i, f"{words} x{i}", f"a{i}", i * 10) for i in range(3)], "doc_id long, text string, done string, n_removed long")
    df = df.withColumns({"ranges": F.col("done"), "block": F.col("done"), "rows": F.col("done"), "kept_0": F.col("done"), "n_words": F.lit("mine")})
    got = repeats.remove_repeats(df, keep=("doc_id", "done", "ranges", "text", "block", "rows", "kept_0", "n_words", "n_removed"), window=5, with_text=True)
    assert got.columns == ["doc_id", "done", "ranges", "text", "block", "rows", "kept_0", "n_words", "n_removed", "kept_sha256", "kept_text"]
    for r in got.collect():
        assert (r.done, r.ranges, r.block, r.rows, r.kept_0) == (f"a{r.doc_id}",) * 5 and r.text == f"{words} x{r.doc_id}"
        assert (r.n_words, r.n_removed, r.kept_text) == (10, 9, f"x{r.doc_id}")


def test_pipeline_carries_columns_of_any_name_and_breaks_ties_alike(spark, tmp_path):
    import corpus_pipeline

    texts = [f"Plain text number {i}. It says little, and ends well. Here are words of {i * 7}." for i in range(24)]
    docs = spark.createDataFrame([(i, t, "en", "ab"[i % 2]) for i, t in enumerate(texts)] + [(3, texts[3], "en", "b")], "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.concat(F.lit(c), "doc_id") for c in ("size", "ids", "done", "score", "spans", "key", "hash", "word", "kept")})
    sf = str(tmp_path)
    spark.createDataFrame([(i, i % 2) for i in range(0, 24, 3)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    got = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        one, two = stage(spark, got, sf), stage(spark, got.repartition(3), sf)
        assert one.columns == docs.columns, name
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())), name
        got = common.materialise(one, name)
    assert all(r.size == f"size{r.doc_id}" and r.kept == f"kept{r.doc_id}" for r in got.collect())
    assert got.where("doc_id = 3").select("text").distinct().count() <= 1
    last = corpus_pipeline.token_ids(spark, got, sf).collect()
    assert len(last) == got.count()
