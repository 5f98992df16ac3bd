"""Cases in which an operator once did less than its whole job."""

import random

import pytest

from glossweave.llm import neardup, quality, topk


def near_copy_group(rng, copies, edits, at):
    """A text of 200 words and copies of it, each with `edits` words of its own: similar to the text and not to each other."""
    base = [f"{at}w{i}" for i in range(200)]
    texts = [base]
    for c in range(copies):
        words = list(base)
        for k in rng.sample(range(1, 30), edits):
            words[6 * k + rng.randrange(2)] = f"{at}c{c}e{k}"
        texts.append(words)
    return [" ".join(w) for w in texts]


def brute_components(texts, least):
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for j in range(len(sets)):
        for i in range(j):
            both = len(sets[i] & sets[j])
            if 100 * both >= least * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("least", "edits"), [(85, 3), (80, 4)])
def test_large_groups_of_distinct_near_copies(spark, least, edits):
    """Every copy links with the text alone, so each link that the long lists lose is a copy that stays."""
    texts = near_copy_group(random.Random(least), 600, edits, "a")
    expected = brute_components(texts, least)
    assert expected == [0] * len(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, least).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def test_pipeline_keeps_one_from_0_8(spark):
    import corpus_pipeline

    # five edits leave 0.77, four 0.81
    texts = near_copy_group(random.Random(1), 3, 4, "a") + near_copy_group(random.Random(2), 3, 5, "b")
    root = brute_components(texts, 80)
    assert root == [0, 0, 0, 0, 4, 5, 6, 7]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == sorted(set(root))


def test_fitted_to_the_least_similarity():
    assert neardup.fitted(85) == (8, 117)
    assert all(neardup.fitted(a).posted >= neardup.fitted(a + 1).posted and neardup.fitted(a).apart > neardup.fitted(a + 1).apart for a in range(20, 100))
    for least in (0, 5, 101):
        with pytest.raises(ValueError):
            neardup.fitted(least)


@pytest.mark.parametrize("seed", range(3))
def test_topk_against_all_products(spark, monkeypatch, seed):
    """Repeated ids, repeated vectors, ties and vectors of several lengths."""
    rng = random.Random(seed)
    kinds = [[rng.randrange(-3, 4) / 2 for _ in range(rng.choice([0, 3, 8, 11]))] for _ in range(25)]
    rows = [(rng.randrange(120) * rng.choice([1, 1, 5]), rng.choice(kinds)) for _ in range(300)]
    ints = [(i, [int(256 * x) for x in v]) for i, v in rows]
    expected = []
    for q in sorted({i for i, _ in ints if i % 50 == 0}):
        scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), j) for i, v in ints if i == q for j, w in ints if j != q]
        expected += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert [tuple(r) for r in topk.search(df).orderBy("query_id", "rank").collect()] == expected


def test_topk_moves_no_vectors_by_queries(spark):
    plans = topk.search(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(60)], "vec_id long, embedding array<float>"))
    plan = plans._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan


def test_large_components_count_or_raise(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(50, [1.0, 0.0]), (1, [float(1 << 21), 1.0]), (2, [-float(1 << 22), 0.0]), (3, [float("inf"), 0.0]), (4, [2.0, 0.0])]
    got = [tuple(r) for r in topk.search(spark.createDataFrame(rows, schema)).orderBy("rank").collect()]
    assert got == [(50, 1, 1, 1 << 37), (50, 2, 4, 1 << 17), (50, 3, 2, -(1 << 38))]
    for x in (1e10, -1e30):
        with pytest.raises(ValueError, match="62 bits"):
            topk.search(spark.createDataFrame([(50, [1.0]), (1, [x])], schema))


def test_products_beyond_what_floats_hold(spark):
    """The scores of equal vectors are the cutoff itself; their last digits are not in a float."""
    schema = "vec_id long, embedding array<float>"
    q, c = ([x / 256 for x in (2.0**29, a, 0, 0, 0, 0, 0, b)] for a, b in ((31, 2), (1, 1)))
    got = [tuple(r) for r in topk.search(spark.createDataFrame([(50, q), *((i, c) for i in range(1, 7))], schema)).orderBy("rank").collect()]
    assert got == [(50, i, i, (1 << 58) + 33) for i in range(1, 6)]


@pytest.mark.parametrize("bits", (26, 28, 29))
def test_large_products_against_brute_force(spark, bits):
    rng = random.Random(bits)
    ints = [(i, [rng.randrange(-(1 << bits), 1 << bits) >> rng.choice([0, 0, 20]) for _ in range(8)]) for i in range(120)]
    rows = [(i, [x / 256 for x in v]) for i, v in ints]
    expected = []
    for q, v in ints[::50]:
        scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ints if j != q]
        expected += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert [tuple(r) for r in topk.search(df).orderBy("query_id", "rank").collect()] == expected


def test_training_lines_are_bounded_and_no_text_is_cut(spark, monkeypatch):
    """Texts that would pass the bound are passed over whole; what trains is whole."""
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, size, firsts, labels: seen.append((len(x), sorted((firsts[1:] - firsts[:-1]).tolist()))))
    texts = [(i, "\n".join(f"line {j} of {i}" for j in range(n))) for i, n in enumerate([5, 7, 90, 3, 400, 4, 6, 2, 5, 8])]
    docs = spark.createDataFrame([*texts, (0, "another row of document 0")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    free = {r.doc_id for r in docs.where(~quality.held_out()).select("doc_id").collect()}
    quality.train(docs, labels, most_lines=40)
    sizes = {i: {len(t.split("\n"))} | ({1} if i == 0 else set()) for i, t in texts}
    n, lines = seen[0]
    assert n == sum(lines) <= 40 and not {90, 400} & set(lines)
    assert all(any(k in sizes[i] for i in free) for k in lines)
    quality.train(docs, labels, most_lines=10_000)
    assert sum(seen[1][1]) > 400 or 4 not in free
