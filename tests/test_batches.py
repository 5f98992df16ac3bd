"""Links, groups and expected counts made for a batch of rows at once, against row by row."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from glossweave.config import PAIRS
from glossweave.functions.normalize import norm_ja, norm_ja_batch
from glossweave.operators import align as al
from glossweave.operators import count as ct
from glossweave.operators import postings, reports, translation
from glossweave.plans import inputs, queries


def test_batch_links_and_groups_against_each_row():
    rng = np.random.default_rng(1)
    matrix = rng.integers(-9, 9, (30, 6)).astype(np.int16)
    lengths = [[*rng.integers(0, 12, 60), 300, 0, 1100, 5], [*rng.integers(0, 12, 60), 290, 4, 3, 1]]
    sides = [(np.concatenate([[0], np.cumsum(n)]), np.concatenate([np.arange(x) * 2 for x in n]), rng.integers(0, 30, sum(n)), matrix) for n in lengths]
    row, i, j = al.batch_links(sides, 0.05, 0.11)
    links, groups = (x.to_pylist() for x in al.link_columns(row, i, j, 64))
    for r, ((at1, u), (at2, v)) in enumerate(al._row_pairs(sides)):
        expected = [(at1[a], at2[b]) for a, b in zip(*al.linked(u, v, 0.05, 0.11), strict=True)] if len(u) and len(v) else []
        assert [(x["i"], x["j"]) for x in links[r]] == expected
        assert [(g["src"], g["trg"]) for g in groups[r]] == al.grouped_links(expected)
    assert len(row) > 100


def test_groups_of_links_in_any_turn():
    rng = random.Random(2)
    for components in (False, True):
        rows = [list(dict.fromkeys((rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(9)))) for _ in range(200)]
        rows = [sorted(x, key=lambda p: p[0]) if k % 2 else x for k, x in enumerate(rows)]
        for some in (rows, rows[1::2]):
            row, i, j = np.array([(k, a, b) for k, x in enumerate(some) for a, b in x]).T
            groups = al.link_columns(*al.in_turn(row, i, j), len(some), components)[1].to_pylist()
            assert [[(g["src"], g["trg"]) for g in x] for x in groups] == [al.grouped_links(x, components) for x in some]


def test_elements_of_a_batch_against_column_functions(spark):
    rng = random.Random(3)
    words, codes, rows = ["is", "of", "to", "de", "was", "x", "yy"], ["", "n", "v", "a", "n/v"], []
    for k in range(300):
        n = [rng.randrange(1, 7) for _ in range(2)]
        links = sorted({(rng.randrange(n[0]), rng.randrange(n[1])) for _ in range(4)})
        rows.append((k, *[[rng.choice(x) for _ in range(m)] for m in n for x in (words, codes)], al.grouped_links(links)))
    df = spark.createDataFrame(rows, f"row_pos long, w1 array<string>, p1 array<string>, w2 array<string>, p2 array<string>, groups {al.GROUPS}").repartition(3)
    for config in (queries.CONFIG, *list(PAIRS.values())[:2]):
        i1 = F.concat(al.negated(F.col("w1"), config.negators1), *([al.be_before_verb(F.col("w1"), F.col("p1"))] if config.be_verb else []))
        each = df.select("*", i1.alias("i1"), al.negated(F.col("w2"), config.negators2).alias("i2"), F.explode("groups").alias("x")).where(~F.arrays_overlap("x.src", "i1") & ~F.arrays_overlap("x.trg", "i2"))
        plain = each.select("row_pos", F.get("x.src", F.lit(0)).alias("g"), al.collapsed(F.col("x.src"), F.col("w1"), F.col("p1"), config.joiner1).alias("e1"), al.collapsed(F.col("x.trg"), F.col("w2"), F.col("p2"), config.joiner2).alias("e2"))
        expected = plain.withColumn("codes", al.head_codes(F.col("e1"), F.col("e2")))
        assert sorted(map(repr, al.aligned_groups(df, config).collect())) == sorted(map(repr, expected.collect()))


def test_no_group_is_looked_at_word_by_word_in_a_filter(spark):
    """A condition on codes is no longer the elements of both sides made again inside it."""
    plan = queries.QUERIES["head_pos"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction") < 20


def test_tags_are_made_once_for_each_word(spark):
    """No array of codes inside the function of a word."""
    plan = queries.QUERIES["report_tags"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "get(transform(" not in plan and plan.count("md5(") <= 2
    toks = spark.createDataFrame([(1, [("a", "n"), ("b", "")])], "row_pos long, toks array<struct<word:string,pos:string>>")
    assert reports.tags(toks).first().line == "a:n b:N/A"


def test_blocks_grow_with_words_and_not_with_pairs(spark, monkeypatch):
    """A sentence of one word again and again is one pair; one of many pairs is parted."""
    batch = pa.RecordBatch.from_pydict({"row_pos": [5, 6], "w1": [["la"] * 3000, list("abc")], "w2": [["li"] * 3000, list("xyzx")]})
    monkeypatch.setattr(translation, "BLOCK_PAIRS", 4)
    blocks = [translation._Block(x) for x in translation._cut(iter([batch]))]
    assert max(b.n for b in blocks) == 4 and [len(b.places) for b in blocks] == [2, 4, 4, 4]
    table = translation._expected(blocks[0], np.full(2, 1 << 24)).to_pylist()
    assert [(x["w1"], x["c"]) for x in table] == [("", 3000 * (65536 // 3001)), ("la", 3000 * 3000 * (65536 // 3001))]


def test_words_are_counted_before_their_codes_are_made(spark):
    tokens = spark.createDataFrame([(1, 0, "a"), (2, 3, "b"), (0, 1, "a"), (3, 0, ",")], "row_pos long, idx int, word string")
    totals = ct.word_totals(tokens)
    assert {r.word: (r["count"], tuple(r.first)) for r in totals.collect()} == {"a": (2, (0, 1)), "b": (1, (2, 3)), ",": (1, (3, 0))}
    coded = lambda df: df.withColumn("pos", F.when(F.col("word") == ",", "").otherwise("n")).withColumn("word", F.lit("x"))
    none = spark.createDataFrame([], "pos string, word string")
    once, each = (ct.token_counts(coded(df), none).collect() for df in (totals, tokens))
    assert once == each and once[0]["count"] == 3
    # the query's codes are made of a row for each distinct word
    plan = queries.QUERIES["token_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" in plan and "posexplode" not in plan


def test_products_of_a_batch_against_each_row():
    """Sentence pairs of about one length are multiplied together, with or without probabilities."""
    rng = np.random.default_rng(4)
    matrix = rng.integers(-9, 9, (30, 6)).astype(np.int16)
    lengths = [[*rng.integers(0, 12, 60), 300, 0, 1100], [*rng.integers(0, 12, 60), 290, 4, 3]]
    sides = [(np.concatenate([[0], np.cumsum(n)]), np.arange(sum(n)), rng.integers(0, 30, sum(n)), matrix) for n in lengths]
    for scale in (None, 0.05):
        got, calls = {}, 0
        for of, a, b, dots, *probs in al.batch_products(sides, scale):
            calls += 1
            for at in zip(*np.nonzero(np.isfinite(dots)), strict=True):
                got[int(of[at[0]]), int(a + at[1]), int(b + at[2])] = [x[at] for x in (dots, *probs) if x is not None]
        expected = {(r, int(a + i), int(b + j)): [x[i, j] for x in (dots, *probs) if x is not None] for r, ((_, u), (_, v)) in enumerate(al._row_pairs(sides)) if len(u) and len(v) for a, b, dots, *probs in al.tiles(u, v, scale) for i in range(dots.shape[0]) for j in range(dots.shape[1])}
        assert got.keys() == expected.keys() and all(np.allclose(got[k], x) for k, x in expected.items())
        assert calls < 60


def test_groups_are_made_once_for_both_sides(spark):
    """Neither side's elements or candidates align the corpus again."""
    plan = lambda q: queries.QUERIES[q](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan("span_collapse").count("MapInArrow") == 3 and "Union" not in plan("span_collapse")
    assert "MapInArrow" not in plan("phrase_candidates")


def test_classes_of_words_are_kept_between_batches(monkeypatch):
    monkeypatch.setattr(inputs, "KNOWN_WORDS", 3)
    known: dict = {}
    for words in (["a", "Das", ",", None, "a"], ["das", "7", "a"], []):
        classes, ids = inputs.word_classes(pa.array(words, pa.string()), 7, known)
        heads = [hashlib.md5((w or "").lower().encode()).hexdigest() for w in words]
        assert ids.to_pylist() == [int(h[:6], 16) % 7 for h in heads]
        assert classes.to_pylist() == ["nnnnnnvvvaar"[int(h[0], 16) : int(h[0], 16) + 1] if w and w.isalnum() else "" for w, h in zip(words, heads, strict=True)]
        assert len(known) <= 3


def test_ids_are_looked_up_for_distinct_words(spark):
    """No norm is made of a token: the join to the tokens is by the word alone."""
    plan = queries.QUERIES["id_lookup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "md5(" not in plan and plan.count("Join") == 1


def test_phrases_of_a_batch_against_column_functions(spark):
    rng = random.Random(5)
    rows = [(k, [{"word": rng.choice("abcd"), "pos": rng.choice(["", "n", "n/v"])} for _ in range(rng.choice([0, 1, 1, 2, 3, 5]))]) for k in range(300)]
    df = spark.createDataFrame(rows, f"k long, e {al.ELEMENTS}")
    for most in (1, 2, 3):
        expected = {r.k: r.c for r in df.select("k", F.transform(al.phrase_candidates(F.col("e"), " ", most), lambda c: c["phrase"]).alias("c")).collect()}
        table = df.toArrow().combine_chunks()
        got = al._phrases(table.column("e").combine_chunks(), " ", most).to_pylist()
        assert dict(zip(table.column("k").to_pylist(), got, strict=True)) == expected


def test_facts_come_from_one_pass_over_the_corpus(spark):
    """Words, links, groups and candidates are made in one task; nothing between them is a row."""
    plan = inputs.phrased_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "links" not in plan


def test_word_list_counts_a_batch_at_once(spark):
    """No token is a row: what is grouped are the words of a batch with their counts."""
    plan = inputs.word_list(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate explode(filter" not in plan
    batch = pa.record_batch([pa.array([["a", "b", "a", ","], [], ["a", "b"], None]), pa.array([["n", "n", "v", ""], [], ["n", "n"], None])], names=["w1", "p1"])
    assert sorted(map(tuple, (r.values() for r in inputs.phrase_counts(batch).to_pylist()))) == [("n", "a", 2), ("n", "a b", 2), ("n", "b", 2), ("v", "a", 1)]


def test_a_list_at_hand_is_looked_up_by_hashes_in_order(spark):
    """A batch makes no table of the whole list, and a word of the same hash that is not the word itself is no hit."""
    hand = al.list_at_hand(spark.createDataFrame([("n", w, k) for k, w in enumerate("abc")], "pos string, word string, id long"), ("pos", "word", "id")).value
    assert (np.diff(hand[0]) > 0).all()
    at = [al._places(hand, pa.array(["n", "n"]), pa.array(["a", x]), np.array([hand[0][hand[1].to_pylist().index("n\ta")]] * 2)) for x in ("a", "z")]
    assert at[0].tolist() == [at[1][0]] * 2 and at[1].tolist()[1] == -1
    assert hand[2][int(at[1][0])].as_py() == 0


def test_norms_of_a_batch_of_morphemes_against_the_column_function(spark):
    rng = random.Random(6)
    fields = ("midasi", "repname", "hinsi", "bunrui", "katuyou1", "genkei")
    values = (("あ", "い", ""), ("う/う", "え", "/", "お/a/b"), ("名詞", "動詞", "形容詞", "副詞", "助詞"), ("名詞性名詞接尾辞", "*"), ("ナ形容詞", "*"), ("静かだ", "静かな", "だ", "", "き"))
    known = [tuple(rng.choice(v) for v in values) for _ in range(40)]
    rows = [[rng.randrange(40) for _ in range(rng.choice([0, 1, 1, 2, 4]))] for _ in range(200)]
    df = spark.createDataFrame([(k, [dict(zip(fields, known[m], strict=True)) for m in x]) for k, x in enumerate(rows)], f"k int, m array<struct<{','.join(f + ':string' for f in fields)}>>")
    each = df.withColumn("pos", F.explode(F.array(*[F.lit(p) for p in "nvar"]))).select("k", "pos", norm_ja(F.col("pos"), F.col("m")).alias("n")).select("k", "pos", "n.*")
    got = norm_ja_batch({f: pa.array(c, pa.string()) for f, c in zip(fields, zip(*known, strict=True), strict=True)}, np.array([m for x in rows for m in x]), np.array([len(x) for x in rows])).to_pylist()
    assert {(k, f["pos"]): (f["norm"], f["matched"]) for k, x in enumerate(got) for f in x} == {(r.k, r.pos): (r.norm, r.matched) for r in each.collect()}


def test_morphemes_are_no_rows_on_their_way_to_norms(spark):
    """Sentences give their norms at once, and of ranked analyses only those that count are made."""
    plan = lambda q: queries.QUERIES[q](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "repname" not in plan("norm_ja") and "transform(" not in plan("norm_ja")
    ranks = plan("norm_ja_nbest")
    assert ranks.index("ArrowEvalPython") < ranks.index("<= 5)")


def test_segments_of_rare_relations_go_on_together():
    """A batch of relations with an example each is a batch of segments, and again one of rows."""
    rows = pa.record_batch([pa.array(["n"] * 500), pa.array(range(500)), pa.array(range(0, 1000, 2)), pa.array([1] * 500, pa.int32()), pa.array([None, *(f"{k}-é" for k in range(499))])], names=["pos", "relation_id", "row_pos", "seq", "id"])
    cut = list(postings._cut(iter([rows.slice(0, 200), rows.slice(200)])))
    assert [b.num_rows for b in cut] == [500]
    assert [b.to_pylist() for b in postings._rows(iter(cut))] == [rows.to_pylist()]
