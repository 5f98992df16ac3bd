"""The jobs over files, for every pair, and the hand-made cases of the operators."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glossweave.config import ENGLISH_NOT, PAIRS, PairConfig
from glossweave.functions import text as tx
from glossweave.functions.normalize import norm_ja_ranked, norm_ko
from glossweave.operators import align as al
from glossweave.operators import count as ct
from glossweave.operators import translation
from glossweave.plans import inputs, jobs
from glossweave.sources import files
from glossweave.streaming import relations
from glossweave.streaming.store import Store

KINDS = {"dog": "n", "hund": "n", "cat": "n", "katze": "n", "sees": "v", "sieht": "v", "big": "a", "gross": "a"}
#: Words that stand for each other have one vector.
SAME = {"dog": 0, "hund": 0, "cat": 1, "katze": 1, "sees": 2, "sieht": 2, "big": 3, "gross": 3, "not": 4, "nicht": 4, "the": 5, "der": 5}


def by(known, default):
    return lambda c: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.lower(c)), F.lit(default))


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, [20 * (i == j) for j in range(6)]) for i in range(6)], "vec_id long, vec array<long>")


def language():
    return jobs.by_lexicon(by(KINDS, ""), lambda phrase, pos: F.regexp_replace(F.lower(phrase), "s$", ""))


def setup(tmp_path, config):
    (tmp_path / "corpus").mkdir()
    rows = ['1,the dog sees,der hund sieht,{},False', '2,"the cat, the @dog","der katze, der hund",{None},f', "3,broken,row", '4,not dog,nicht hund,,t', '5,"big ""cat""\n",gross katze,{},False']
    (tmp_path / "corpus" / "a.csv").write_text("\n".join(rows) + "\n")
    for lang in (config.la1, config.la2):
        for pos, words in (("n", ["id,word,invalid", "0,dog,f", "1,cat,f", "2,hund,f", "3,katze,f", "4,hunds,f"]), ("v", ["0,see,f", "1,sieht,f"]), ("a", ["0,big,f", "1,gros,f"])):
            folder = tmp_path / "lists" / f"lang={lang}" / f"pos={pos}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / "list.csv").write_text("\n".join(words) + "\n")


@pytest.mark.parametrize("name", sorted(PAIRS))
def test_every_pair(spark, vectors, tmp_path, name):
    config = jobs.pair_config(name)
    setup(tmp_path, config)
    encode = jobs.word_encoder(vectors, by(SAME, -1)) if name != "en_fr" else jobs.piece_encoder(vectors, by(SAME, -1), 8)
    languages = {config.la1: language(), config.la2: language()}
    at = jobs.count_translations(spark, config, str(tmp_path / "corpus"), str(tmp_path / "lists"), str(tmp_path / "out"), languages, encode)
    relations = {(r.pos, r.id1, r.id2): (r["count"], sorted(r.examples)) for r in files.read_relations_csv(spark, at["relations"]).collect()}
    # a negator takes the word after it out, if the pair has it
    negated = any("not" in n.words for n in config.negators1)
    dogs = ["1", "2"] if negated else ["1", "2", "4"]
    assert relations[("n", 0, 2)] == (len(dogs), dogs)
    assert relations[("n", 1, 3)] == (2, ["2", "5"])
    assert ("v", 0, 1) in relations or ("v", 1, 1) in relations or not any(k[0] == "v" for k in relations)
    assert [r.value for r in spark.read.text(at["rejected"]).collect()] == ["3,broken,row"]
    written = {r.id: r.commands for r in files.split_arity(files.read_corpus(spark, at["corpus"]))[0].collect()}
    assert set(written) == {"1", "2", "4", "5"} and "'dog'" in written["1"]


def test_drop_invalid_failed_rows_and_word_lists(spark, vectors, tmp_path):
    config = jobs.pair_config("de_en")
    setup(tmp_path, config)
    fails = jobs.Language(lambda s: F.when(~s.contains("katze"), language().tag(s)), language().norm)
    at = jobs.count_translations(spark, config, str(tmp_path / "corpus"), str(tmp_path / "lists"), str(tmp_path / "out"), {"de": language(), "en": fails}, jobs.word_encoder(vectors, by(SAME, -1)), drop_invalid=True)
    assert sorted(r._c0 for r in spark.read.csv(at["failed"], escape='"', multiLine=True).collect()) == ["2", "5"]
    rows, _ = jobs.read_rows(spark, str(tmp_path / "corpus"), drop_invalid=True)
    assert sorted(r.id for r in rows.collect()) == ["1", "2", "5"]
    built = jobs.build_wordlist(spark, str(tmp_path / "corpus"), 1, language(), spark.createDataFrame([], "pos string, word string"), str(tmp_path / "new"))
    assert built.count() == 0


def test_pair_compat():
    assert jobs.pair_config("en_it", True).la1 == "it" and jobs.pair_config("en_it").la1 == "en"
    assert jobs.pair_config("de_en", True).overrides == ("it",)


def test_overrides_come_before_norms(spark):
    candidates = spark.createDataFrame([(1, 0, 1, 0, "Dogs", [("n", "dog")]), (1, 1, 1, 0, "cats", [("n", "cat")])], "row_pos long, g int, side int, place int, phrase string, norms array<struct<pos:string,norm:string>>")
    listed = spark.createDataFrame([("n", "hound", 7), ("n", "cat", 8)], "pos string, word string, id long")
    over = spark.createDataFrame([("n", "Dogs", "hound")], "pos string, surface string, normalized string")
    assert sorted((r.g, r.found[0].id) for r in al.longest_match(candidates, listed, over).collect()) == [(0, 7), (1, 8)]


@pytest.mark.parametrize(
    ("links", "expected", "joined"),
    [
        ([(0, 0), (0, 1), (1, 1)], [([0, 1], [0, 1])], [([0, 1], [0, 1])]),
        ([(0, 0), (1, 1), (2, 0), (2, 1)], [([0, 2], [0]), ([1], [1])], [([0, 1, 2], [0, 1])]),
    ],
)
def test_groups(links, expected, joined):
    assert al.grouped_links(links) == expected
    assert al.grouped_links(links, True) == joined


def one(spark, schema, row, column):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first().x


def test_ignored_positions(spark):
    assert one(spark, "w array<string>", (["is", "not", "good"],), al.negated(F.col("w"), ENGLISH_NOT)) == [2]
    assert one(spark, "w array<string>, p array<string>", (["was", "seen"], ["v", "v"]), al.be_before_verb(F.col("w"), F.col("p"))) == [0]


def test_span_collapse(spark):
    got = one(spark, "at array<int>, w array<string>, p array<string>", ([0, 1, 2, 3], ["the", "big", "red", "of"], ["", "a", "a", ""]), al.collapsed(F.col("at"), F.col("w"), F.col("p"), " "))
    assert [(t.word, t.pos) for t in got] == [("the", ""), ("big red", "a/a"), ("of", "")]


@pytest.mark.parametrize(("compat", "tokens", "expected"), [
    (False, [("酒店", "n"), ("的", "de"), ("班车", "n")], [("酒店的", "a"), ("班车", "n")]),
    (False, [("的", "de"), ("人", "n"), ("第", "prefix")], [("的", ""), ("人", "n"), ("第", "")]),
    (True, [("的", "de"), ("人", "n")], None),
    (True, [("人", "n"), ("第", "prefix")], [("人", "n"), ("第", "prefix")]),
    (False, [], []),
])
def test_merge_zh(spark, compat, tokens, expected):
    got = one(spark, "t array<struct<word:string,pos:string>>", (tokens,), tx.merged_zh(F.col("t"), compat))
    assert got is expected or [(t.word, t.pos) for t in got] == expected


def test_merge_ja(spark):
    kind = "array<struct<midasi:string,hinsi:string,bunrui:string,katuyou1:string,katuyou2:string,genkei:string>>"
    noun_verb = [("勉強", "名詞", "サ変名詞", "*", "*", "勉強"), ("する", "動詞", "*", "サ変動詞", "基本形", "する"), ("作用", "名詞", "普通名詞", "*", "*", "作用")]
    got = one(spark, f"m {kind}", (noun_verb,), tx.merged_ja(F.col("m")))
    assert [(t.word, t.pos) for t in got] == [("勉強する", "v"), ("作用", "n")]


def test_longest_match_takes_the_first_of_equal_length(spark):
    e = [("pick", ""), ("up", "v"), ("now", "")]
    got = one(spark, "e array<struct<word:string,pos:string>>", (e,), al.phrase_candidates(F.col("e"), " "))
    assert [c.idx for c in got] == [[0, 1, 2], [0, 1], [1, 2], [1]]
    assert [c.idx for c in one(spark, "e array<struct<word:string,pos:string>>", (e,), al.phrase_candidates(F.col("e"), " ", 1))] == [[1]]


def test_closure(spark):
    words = spark.createDataFrame([("v", "plays", 0, "play"), ("v", "played", 1, "play")], "pos string, word string, id long, norm string")
    assert [(r.word, r.id) for r in ct.wordlist_closure(words).collect()] == [("play", 2)]
    assert [(r.word, r.id) for r in ct.wordlist_closure(words, True).collect()] == [("play", 3)]


def test_pieces_take_part_up_to_the_limit(spark, vectors):
    rows = spark.createDataFrame([(1, ["dogdog", "cat"], ["cat", "dog"])], "row_pos long, w1 array<string>, w2 array<string>")
    for limit, expected in ((9, [(0, 1), (1, 0)]), (2, [(0, 1)])):
        encoded, vecs = jobs.piece_encoder(vectors, by(SAME, -1), 3, limit)(rows)
        got = al.sentence_links(encoded, vecs, 1.0, 1e-3).first()
        assert [(x.i, x.j) for x in got.links] == expected


def test_relations_in_two_halves(spark):
    facts = spark.createDataFrame([(i, 0, f"r{i}", "n", i % 3, 0) for i in range(10)], "row_pos long, seq int, id string, pos string, id1 long, id2 long")
    whole = ct.relation_ids(ct.collect_examples(facts)).select("relation_id", "id1", "count", "examples")
    first = ct.relation_ids(ct.collect_examples(facts.where("row_pos < 4"))).select("relation_id", "pos", "id1", "id2", "count", "examples")
    merged = ct.merge_relations(first, facts.where("row_pos >= 4")).select("relation_id", "id1", "count", "examples")
    assert sorted(whole.collect()) == sorted(merged.collect())


def test_versions_hold_examples_as_rows(spark, tmp_path):
    """Batches in turn, one of them twice and one empty, give what one run gives."""
    facts = spark.createDataFrame([(i, 0, f"r{i}", "nv"[i % 2], i % 3, 0) for i in range(12)], "row_pos long, seq int, id string, pos string, id1 long, id2 long")
    whole = ct.relation_ids(ct.collect_examples(facts)).select("pos", "relation_id", "id1", "id2", "count", "examples")
    path = str(tmp_path / "state")
    parts = ["row_pos < 2", "row_pos >= 2 AND row_pos < 5", "false", "row_pos >= 5 AND row_pos < 6", "row_pos >= 6"]
    done = set()
    for n, part in ((1, 0), (2, 1), (2, 1), (3, 2), (4, 3), (5, 4)):
        rows = facts.where(parts[part])
        assert relations.write_snapshot(rows, path, n, rows.agg(F.max("row_pos")).first()[0]) is (n not in done)
        done.add(n)
    got = relations.version(spark, path).select(*whole.columns)
    assert sorted(got.collect()) == sorted(whole.collect())
    assert relations.examples(spark, path, 3).count() == 5 and relations.passed(spark, path) == 11 and relations.passed(spark, path, 3) == 4
    assert [level for level, _ in relations.state(spark, path).manifest(5)["runs"]["totals"]] == [1, 0]


def tree_bytes(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_a_batch_writes_its_own_relations_alone(spark, tmp_path):
    facts = lambda a, b: spark.range(a, b).select(F.col("id").alias("row_pos"), F.lit(0).alias("seq"), F.concat(F.lit("r"), "id").alias("id"), F.lit("n").alias("pos"), F.col("id").alias("id1"), (F.col("id") % 7).alias("id2"))
    path = tmp_path / "state"
    relations.write_snapshot(facts(0, 60_000), str(path), 1, 59_999)
    large = tree_bytes(path)
    relations.write_snapshot(facts(0, 5).unionByName(facts(60_000, 60_005)), str(path), 2, 60_004)
    assert tree_bytes(path) - large < large / 20
    before = sorted(str(p) for p in path.rglob("*"))
    # a batch that is run again
    assert not relations.write_snapshot(facts(0, 50), str(path), 2, 1)
    assert sorted(str(p) for p in path.rglob("*")) == before
    got = {r.id1: (r.relation_id, r["count"]) for r in relations.totals(spark, str(path)).collect()}
    assert len(got) == 60_005 and [got[i] for i in (0, 4, 5, 60_000, 60_004)] == [(0, 2), (4, 2), (5, 1), (60_000, 1), (60_004, 1)]


def test_a_batch_that_fails_leaves_the_one_before(spark, tmp_path):
    path, schema = str(tmp_path / "state"), "a long"
    store = Store(spark, path, {"one": (schema, lambda df: df), "two": (schema, lambda df: df)})
    rows = spark.range(3).select(F.col("id").alias("a"))
    assert store.commit(1, {"one": rows, "two": rows}, {"x": 1})
    broken = rows.select(F.when(F.col("a") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("a")).cast("long").alias("a"))
    with pytest.raises(Exception, match="no"):
        store.commit(2, {"one": rows, "two": broken})
    assert store.version() == 1 and store.read("one").count() == store.read("two").count() == 3
    for n in range(2, 8):
        assert store.commit(n, {"one": rows, "two": rows})
    assert store.read("one").count() == 21 and store.read("one", 5).count() == 15 and store.manifest(7)["notes"] == {}
    # runs that no kept version needs are gone
    used = {f for n in range(5, 8) for runs in store.manifest(n)["runs"].values() for _, f in runs}
    assert used <= {p.name for p in (tmp_path / "state" / "runs").iterdir()} and len(used) < 14


def test_job_with_examples_as_rows(spark, vectors, tmp_path):
    config = jobs.pair_config("de_en")
    setup(tmp_path, config)
    at = jobs.count_translations(spark, config, str(tmp_path / "corpus"), str(tmp_path / "lists"), str(tmp_path / "out"), {"de": language(), "en": language()}, jobs.word_encoder(vectors, by(SAME, -1)), as_rows=True)
    wrote = {(r.pos, r.id1, r.id2): r for r in files.read_relations_csv(spark, at["relations"]).collect()}
    rows = [(r.pos, r.relation_id, r.id) for r in spark.read.parquet(at["examples"]).collect()]
    for (pos, _, _), r in wrote.items():
        assert r.examples == [] and r["count"] == sum(x[:2] == (pos, r.relation_id) for x in rows)
    dog = wrote[("n", 0, 2)]
    assert {x[2] for x in rows if x[:2] == ("n", dog.relation_id)} >= {"1", "2"}


def test_joined_vectors_give_the_same_links(spark, vectors, monkeypatch):
    rows = spark.createDataFrame([(1, [0, 1, 9], [1, 0]), (2, [3], []), (3, None, [2])], "row_pos long, n1 array<long>, n2 array<long>")
    here = sorted(map(str, al.sentence_links(rows, vectors, 1.0, 1e-3).collect()))
    monkeypatch.setattr(al, "VECTOR_BYTES", 0)
    assert sorted(map(str, al.sentence_links(rows, vectors, 1.0, 1e-3).collect())) == here
    assert PairConfig("a", "b").name == "a_b"


def test_documents_beyond_the_row_positions_raise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "SENTENCES", 2)
    for name, text in (("fits", "a. b. c."), ("passes", "a. b. c. d.")):
        spark.createDataFrame([(1, "en", text), (2, "en", "x. y.")], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
    assert sorted(r.row_pos for r in inputs.corpus(spark, f"{tmp_path}/fits").collect()) == [2, 3, 4]
    with pytest.raises(Exception, match="more than 2 sentence pairs in document 1"):
        inputs.corpus(spark, f"{tmp_path}/passes").collect()


def texts_of(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def csv_of(spark, path):
    return sorted(tuple(r[f"_c{i}"] for i in range(len(r))) for r in spark.read.csv(path, escape='"', multiLine=True, recursiveFileLookup=True).collect())


def many_files(folder, names, seed):
    """Files of a few records, of other than five fields too, and with rows that the tagger fails on."""
    rng = random.Random(seed)
    folder.mkdir(exist_ok=True)
    for name in names:
        rows = []
        for k in range(rng.randrange(4)):
            i = f"{name}-{k}"
            rows.append(rng.choice([f"{i},the dog sees,der hund sieht,{{}},False", f"{i},the cat,der katze,,f", f'{i},"big ""cat""\n",gross katze,{{}},t', f"{i},broken", f"{i},the dog fails,der hund,{{}},False", f"{i},dogs,hund,{{}},False"]))
        (folder / f"{name}.csv").write_text("".join(r + "\n" for r in rows))


def failing_language():
    return jobs.Language(lambda s: F.when(~s.contains("fails"), language().tag(s)), language().norm)


@pytest.mark.parametrize("position", ["given", "placed"])
def test_stream_equals_one_run(spark, vectors, tmp_path, position):
    """200 files in two deliveries give the relations, the corpus, the rejected and the failed rows of one batch run."""
    config = jobs.pair_config("de_en")
    setup(tmp_path, config)
    corpus, out = tmp_path / "many", tmp_path / "streamed"
    names = [f"f{i:03d}" for i in range(200)]
    over = tmp_path / "over" / "de"
    over.mkdir(parents=True)
    (over / "n_normalize.csv").write_text("dogs,dogling\n")
    languages = {"de": failing_language(), "en": language()}
    options = {"overrides": str(tmp_path / "over"), "drop_invalid": True}
    encode = jobs.word_encoder(vectors, by({**SAME, "dogs": 0}, -1))
    made, _ = jobs.read_setup(spark, config, str(tmp_path / "lists"), languages, encode, **options)
    at = F.split("id", "-")
    given = None if position == "placed" else F.substring(at[0], 2, 3).cast("long") * 10 + F.coalesce(F.try_to_number(at[1], F.lit("9")).cast("long"), F.lit(0))
    for part in (names[:90], names[90:]):
        many_files(corpus, part, len(part))
        jobs.stream_translations(spark, made, str(corpus), str(out), given).awaitTermination()
    batch = jobs.count_translations(spark, config, str(corpus), str(tmp_path / "lists"), str(tmp_path / "out"), languages, encode, **options)
    whole = sorted((r.pos, r.relation_id, r.id1, r.id2, r["count"], tuple(r.examples)) for r in files.read_relations_csv(spark, batch["relations"]).collect())
    assert sorted((r.pos, r.relation_id, r.id1, r.id2, r["count"], tuple(r.examples)) for r in relations.version(spark, str(out)).collect()) == whole
    assert len(whole) > 2 and sum(r[4] for r in whole) > 50
    assert texts_of(spark, f"{out}/rejected") == texts_of(spark, batch["rejected"]) != []
    for name in ("failed", "corpus"):
        assert csv_of(spark, f"{out}/{name}") == csv_of(spark, batch[name]) != []


def test_positions_of_batches_do_not_collide(spark, tmp_path):
    rows = spark.range(0, 400, 1, 200).select(F.format_string("file%03d", F.col("id") % 40).alias("_file"), F.col("id").alias("a"))
    one, two = (jobs.placed_rows(rows, n * jobs.BATCH_ROWS) for n in (0, 1))
    assert one.agg(F.max("row_pos")).first()[0] == 399 < jobs.BATCH_ROWS == two.agg(F.min("row_pos")).first()[0]
    got = [r.a % 40 for r in one.orderBy("row_pos").collect()]
    assert got == sorted(got)


def test_positions_do_not_depend_on_how_files_are_packed(spark, tmp_path):
    many_files(tmp_path / "many", [f"f{i:02d}" for i in range(30)], 3)
    seen = []
    for size in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows, _ = jobs.read_rows(spark, str(tmp_path / "many"))
        seen.append([r.id for r in rows.orderBy("row_pos").collect()])
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] == sorted(seen[0]) and len(seen[0]) > 20


def test_overrides_count_in_the_closure(spark, vectors, tmp_path):
    """The listed word dog is overridden: its form joins the list and the relation is of it."""
    config = jobs.pair_config("de_en")
    setup(tmp_path, config)
    over = tmp_path / "over" / "de"
    over.mkdir(parents=True)
    (over / "n_normalize.csv").write_text("dog,dogling\n")
    at = jobs.count_translations(spark, config, str(tmp_path / "corpus"), str(tmp_path / "lists"), str(tmp_path / "out"), {"de": language(), "en": language()}, jobs.word_encoder(vectors, by(SAME, -1)), overrides=str(tmp_path / "over"))
    listed = {(r.lang, r.word): r.id for r in files.read_wordlist(spark, at["wordlists"]).where("pos = 'n'").collect()}
    relations_of = {(r.id1, r.id2): r["count"] for r in files.read_relations_csv(spark, at["relations"]).where("pos = 'n'").collect()}
    assert ("de", "dogling") in listed and relations_of[(listed["de", "dogling"], 2)] == 3 and (0, 2) not in relations_of


def test_a_job_goes_on_from_an_earlier_one(spark, vectors, tmp_path):
    config = jobs.pair_config("de_en")
    setup(tmp_path, config)
    many_files(tmp_path / "many", [f"f{i:02d}" for i in range(40)], 5)
    encode, languages, out = jobs.word_encoder(vectors, by(SAME, -1)), {"de": language(), "en": language()}, str(tmp_path / "out")
    run = lambda corpus, **more: jobs.count_translations(spark, config, str(corpus), str(tmp_path / "lists"), out, languages, encode, **more)
    whole = run(tmp_path / "many")
    assert jobs.outputs(spark, out) == whole
    first = tmp_path / "first"
    first.mkdir()
    for i in range(25):
        (first / f"f{i:02d}.csv").write_text((tmp_path / "many" / f"f{i:02d}.csv").read_text())
    begun = run(first)
    start = sum(r.record is not None for r in jobs.read_rows(spark, str(first))[1].collect()) + jobs.read_rows(spark, str(first))[0].count()
    rest = run(tmp_path / "many", earlier=files.read_relations_csv(spark, begun["relations"]), start=start)
    assert jobs.outputs(spark, out) == rest != begun
    show = lambda at: sorted(map(str, files.read_relations_csv(spark, at["relations"]).collect()))
    assert show(rest) == show(whole) != show(begun)
    assert sorted(csv_of(spark, begun["corpus"]) + csv_of(spark, rest["corpus"])) == csv_of(spark, whole["corpus"])


def test_a_job_that_fails_leaves_what_was_there(spark, vectors, tmp_path, monkeypatch):
    config = jobs.pair_config("de_en")
    setup(tmp_path, config)
    out = str(tmp_path / "out")
    assert jobs.outputs(spark, out) == {}
    run = lambda: jobs.count_translations(spark, config, str(tmp_path / "corpus"), str(tmp_path / "lists"), out, {"de": language(), "en": language()}, jobs.word_encoder(vectors, by(SAME, -1)))
    before = run()
    monkeypatch.setattr(files, "render_commands", lambda c: F.raise_error(F.lit("a task fails")).cast("string"))
    with pytest.raises(Exception, match="a task fails"):
        run()
    assert jobs.outputs(spark, out) == before
    assert files.read_relations_csv(spark, before["relations"]).count() > 0


def test_morphemes_reach_the_norm(spark, vectors, tmp_path):
    """A Korean and a Japanese norm look at what the analysis made of a phrase."""
    morphs = lambda c: F.array(F.struct(F.substring(c, 1, 2).alias("morph"), F.lit("VA").alias("tag")), F.struct(F.lit("x").alias("morph"), F.lit("JKS").alias("tag")))
    korean = jobs.by_lexicon(by({"예쁘게": "a"}, ""), norm_ko, morphs)
    fields = ("midasi", "repname", "hinsi", "bunrui", "katuyou1", "katuyou2", "genkei")
    one = lambda c, kind: F.array(F.struct(*[v.alias(f) for f, v in zip(fields, (c, F.concat(F.lower(c), F.lit("/x")), F.lit(kind), F.lit("*"), F.lit("*"), F.lit("*"), c), strict=True)]))
    ranked = jobs.by_lexicon(by({"Big": "a"}, ""), norm_ja_ranked, lambda c: F.array(one(c, "名詞"), one(c, "形容詞")))
    rows = spark.createDataFrame([(1, "1", ["Big"], ["a"], ["예쁘게"], ["a"])], "row_pos long, id string, w1 array<string>, p1 array<string>, w2 array<string>, p2 array<string>")
    lists = (spark.createDataFrame([("a", "big", 3)], "pos string, word string, id long"), spark.createDataFrame([("a", "예쁘다", 5)], "pos string, word string, id long"))
    made = jobs.Setup(PairConfig("ja", "ko"), (ranked, korean), jobs.word_encoder(vectors, by({"big": 0, "예쁘게": 0}, -1)), lists, spark.createDataFrame([], "norm1 string, norm2 string"))
    assert [(r.pos, r.id1, r.id2) for r in jobs.facts_of_rows(rows, made).collect()] == [("a", 3, 5)]
    grown, added = jobs.grown_list(spark.createDataFrame([("a", "예쁘게", 0)], "pos string, word string, id long"), korean)
    assert [(r.word, r.id) for r in added.collect()] == [("예쁘다", 1)] and grown.count() == 2


def test_ranked_analyses(spark):
    """The first rank that matches counts; ranks after an empty one do not; without a match the first rank's norm stays."""
    m = lambda kind, base: [("s", "s", kind, "*", "*", "*", base)]
    kind = "array<array<struct<midasi:string,repname:string,hinsi:string,bunrui:string,katuyou1:string,katuyou2:string,genkei:string>>>"
    cases = [([m("名詞", "one"), m("動詞", "two"), m("動詞", "three")], "two"), ([m("名詞", "one"), [], m("動詞", "three")], "s"), ([m("名詞", "one")] * 5 + [m("動詞", "six")], "s"), ([m("動詞", "one")], "one"), ([], "")]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], f"i int, r {kind}")
    assert [r.n for r in df.select("i", norm_ja_ranked(F.lit("w"), F.lit("v"), F.col("r")).alias("n")).orderBy("i").collect()] == [n for _, n in cases]


def test_expectation_maximisation_against_plain_rounds(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice("ABCde") for _ in range(rng.randrange(7))], [rng.choice("xyz") for _ in range(rng.randrange(6))]) for i in range(60)] + [(90, None, ["x"]), (91, ["A"], None)]
    df = spark.createDataFrame(rows, "row_pos long, w1 array<string>, w2 array<string>").repartition(3)
    lower = [(i, ["", *(w.lower() for w in a or [])], list(b or [])) for i, a, b in rows]
    t = {(x, y): 1 for _, a, b in lower for x in a for y in b}
    for _ in range(3):
        counts = Counter()
        for _, a, b in lower:
            for y in b:
                total = sum(t[x, y] for x in a)
                for x in a:
                    counts[x, y] += t[x, y] * 65536 // total
        totals = Counter()
        for (x, _), c in counts.items():
            totals[x] += c
        t = {(x, y): max(1, c * (1 << 24) // max(1, totals[x])) for (x, y), c in counts.items()}
    blocks = translation.sentence_blocks(df)
    assert {(r.w1, r.w2): r.t for r in translation.translation_table(blocks, 3).collect()} == t
    links = {i: sorted((k - 1, j) for j, y in enumerate(b) for k in [max(range(len(a)), key=lambda k: (t[a[k], y], -k))] if k) for i, a, b in lower}
    got = translation.em_links(df, 3).collect()
    assert {r.row_pos: [(x.i, x.j) for x in r.links] for r in got} == links
    assert all([(g.src, g.trg) for g in r.groups] == al.grouped_links(links[r.row_pos]) for r in got)


def test_job_without_an_encoder(spark, tmp_path):
    """Words that stand in the same sentences are linked: no vectors anywhere."""
    config = jobs.pair_config("de_en")
    setup(tmp_path, config)
    corpus = tmp_path / "pairs"
    corpus.mkdir()
    sentences = [("the dog", "der hund"), ("the cat", "der katze"), ("dog", "hund"), ("the dog sees", "der hund sieht"), ("cat sees", "katze sieht"), ("the big dog", "der gross hund")]
    (corpus / "a.csv").write_text("".join(f"{i},{a},{b},{{}},False\n" for i, (a, b) in enumerate(sentences * 3)))
    at = jobs.count_translations(spark, config, str(corpus), str(tmp_path / "lists"), str(tmp_path / "out"), {"de": language(), "en": language()}, jobs.Unencoded(6))
    found = {(r.pos, r.id1, r.id2): r["count"] for r in files.read_relations_csv(spark, at["relations"]).collect()}
    assert found[("n", 0, 2)] == 12 and found[("n", 1, 3)] == 6 and ("n", 0, 3) not in found


@pytest.mark.parametrize("override", [False, True])
def test_facts_in_place_equal_those_by_joins(spark, monkeypatch, override):
    """Groups of up to 200 elements; words under several codes; overrides; nulls in the list."""
    rng = random.Random(9)
    words = [f"W{i}" for i in range(40)]
    rows, phrases = [], []
    for i, n in enumerate([1, 2, 3, 5, 8, 13, 200, *[4] * 60]):
        sides, code = [], rng.choice(["n", "v", "n/v"])
        for _ in "ab":
            w, head = [rng.choice(words) for _ in range(n)], rng.randrange(n)
            sides += [w, [code if k == head else "" for k in range(n)]]
            for size in (1, 2, 3):
                at = sorted({head, *rng.sample(range(n), min(n, size - 1))})
                phrases += [" ".join(w[k] for k in at).lower()] if rng.random() < 0.6 else []
        rows.append((i, *sides, [{"src": list(range(n)), "trg": list(range(n))}]))
    df = spark.createDataFrame(rows, "row_pos long, w1 array<string>, p1 array<string>, w2 array<string>, p2 array<string>, groups array<struct<src:array<int>,trg:array<int>>>").repartition(3)
    listed = spark.createDataFrame([*{(p, w): (p, w, i) for i, w in enumerate(phrases) for p in rng.sample("nva", rng.choice([1, 2, 2]))}.values(), (None, "x", 1), ("n", None, 2)], "pos string, word string, id long")
    over = spark.createDataFrame([("n", w, words[0].lower()) for w in words[1:20:3]], "pos string, surface string, normalized string") if override else None
    none = spark.createDataFrame([], "norm1 string, norm2 string")
    run = lambda: sorted(map(tuple, al.align_pipeline(df, PairConfig("a", "b"), listed, listed.where("id % 9 > 0"), none, lambda phrase, pos, side: F.lower(phrase), (over, None)).select("row_pos", "g", "pos", "id1", "word1", "norm1", "id2", "word2", "norm2").collect()))
    plan = al.facts_in_place
    here, used = [], []
    monkeypatch.setattr(al, "facts_in_place", lambda *a: used.append(1) or plan(*a))
    here = run()
    assert used and len(here) > 15
    monkeypatch.setattr(al, "list_at_hand", lambda *a, **k: None)
    assert run() == here and len(used) == 1
    assert any(len(r[4].split()) == 3 for r in here) and len({r[:2] for r in here}) < len(here)


def test_facts_in_place_shuffle_nothing(spark, monkeypatch):
    rows = spark.createDataFrame([(1, ["A"], ["n"], ["B"], ["n"], [{"src": [0], "trg": [0]}])], "row_pos long, w1 array<string>, p1 array<string>, w2 array<string>, p2 array<string>, groups array<struct<src:array<int>,trg:array<int>>>")
    listed = spark.createDataFrame([("n", "a", 1), ("n", "b", 2)], "pos string, word string, id long")
    hand = al.list_at_hand(listed, ("pos", "word", "id"))
    facts = al.facts_in_place(al.aligned_groups(rows, PairConfig("a", "b")), PairConfig("a", "b"), lambda phrase, pos, side: F.lower(phrase), (hand, hand), (None, None))
    assert "Exchange" not in facts._jdf.queryExecution().executedPlan().toString()
    assert [(r.id1, r.id2, r.norm1) for r in facts.collect()] == [(1, 2, "a")]
    assert al.list_at_hand(listed.unionByName(listed), ("pos", "word", "id")) is None and al.list_at_hand(listed, ("pos", "word", "id"), 0) is None
