"""Source divergence, language-model scores and vector codes against plain restatements, and their odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossweave.llm import codes, common, divergence, lm

SF = "/root/testdata/sf0.001"


# --- divergence


def plain_divergences(docs, least, shown):
    seen, df, counts, groups = [], defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, source, lang in docs:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang].add(source)
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    for lang, sources in groups.items():
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        n_of = lambda c: sum(c[t] for t in kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (n_of(c) + 5 * len(kept)) for t in kept}
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            seen += [(lang, s, part, x, -v, r + 1) for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:shown])) for r, (v, _, x) in enumerate(rows)]
    return sorted(seen)


@pytest.mark.parametrize(("group_block", "term_block"), [(128, 2048), (3, 7), (1, 1)])
def test_divergence_against_plain_sums(spark, group_block, term_block):
    """Blocks of every size give the same; nulls, empty texts, languages without terms, characters beyond ASCII, repeated rows and one large source."""
    rng = random.Random(1)
    words = ["Alpha", "BETA", "gamma", "été", "漢字", "x1y", "don't", "Ā"] + [f"w{'abcdef'[i % 6]}{'ghij'[i % 4]}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(30))), rng.choice(["s1"] * 6 + [f"s{k}" for k in range(7)] + ["É", None]), rng.choice(["en", "fr", None])) for i in range(150)]
    docs += [docs[3]] * 4 + [(900, None, "only", "en"), (901, "", "bare", "xx"), (902, "1 2 3", "other", "xx"), (None, "alpha", "", "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").withColumns({c: F.lit(1) for c in ("term", "n", "gid", "p", "value", "rank")}).repartition(3)
    got = divergence.divergences(df, 12, 5, group_block, term_block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_divergences(docs, 12, 5)


def test_divergence_without_rows(spark):
    assert divergence.divergences(spark.createDataFrame([], "doc_id long, text string, source string, lang string")).collect() == []


# --- language model


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


LM_ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "The dog saw the dog. " * 400), (5, "a b a b a c"), (6, "a b a b a c"), (6, "a b a b a c"), (None, "no id HERE é 漢字"), (7, "x" * 100_000 + " y"), *((i, f"the cat number {i % 7} saw a dog {i % 3}") for i in range(8, 60))]


def test_lm_counts_and_base_score(spark):
    df = spark.createDataFrame(LM_ROWS, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("block", "word", "trains", "kept_0", "score")}).repartition(3)
    got = lm.score_texts(df, ~lm.held_out(), ("doc_id", "block", "score"))
    assert got.columns == ["doc_id", "block", *lm.OUTPUTS]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in LM_ROWS if not held(i) for w in [*words_of(t), None])
    n, v = sum(c.values()), len(c)
    expected = sorted((str(i), len(words_of(t)) + 1, sum(c[w] > 0 for w in [*words_of(t), None]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words_of(t), None]), 6)) for i, t in LM_ROWS)
    assert any(held(i) for i, _ in LM_ROWS)
    assert sorted((str(r[0]), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.collect()) == expected


def test_lm_same_however_rows_are_dealt_and_better_than_the_base(spark, monkeypatch):
    docs = common.read_table(spark, SF, "documents")
    run = lambda df: {r.doc_id: r for r in lm.score_texts(df.withColumn("held_out", lm.held_out()), ~lm.held_out(), ("doc_id", "held_out")).collect()}
    one = run(docs)
    two = run(docs.repartition(5, "source"))
    assert {k: round(r.score, 2) for k, r in one.items()} == {k: round(r.score, 2) for k, r in two.items()}
    held = [r for r in one.values() if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    # perplexity of texts that were not learnt from
    assert len(held) > 10 and sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.3
    empty = docs.where("false")
    assert lm.score_texts(empty, F.lit(True)).collect() == []
    untrained = lm.score_texts(docs.limit(3), F.lit(False)).collect()
    assert all(r.score == r.base_score == 0 and r.n_known == r.train_tokens == 0 for r in untrained)


def test_lm_probabilities_of_a_context_sum_to_one(spark):
    """Held-out texts hold every word after every context, known or not, so the cells of a restaurant are all words."""
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(12)]
    learnt = [(True, " ".join(rng.choices(vocabulary, range(12, 0, -1), k=rng.randrange(40)))) for _ in range(60)] + [(True, "v0 v1 " * 300)]
    seen = sorted({w for _, t in learnt for w in t.split()})
    asked = [(False, f"{a} {b}") for a in seen for b in [*seen, "unknown"]]
    texts = spark.createDataFrame([(t, x) for x, t in learnt + asked], "text string, trains boolean").repartition(3)
    model = lm.word_model(texts)
    cells = common.materialise(texts.mapInArrow(lm._blocks(model, common.shared_dir(spark, "lm"), 4), lm.SENT).groupBy("bucket").applyInArrow(lm._meet, lm.CELLS), "lm-cells")
    model = lm.fit(cells, model, 3)
    total, customers, tables = Counter(), Counter(), Counter()
    for r in cells.collect():
        s = lm.Seating(model, r.asDict())
        for number, state in enumerate(model.rounds[:-1]):
            s.draw(number + 1, state)
        assert ((s.t <= s.c) & (s.t >= np.minimum(s.c, 1))).all()
        for u, p, c, t in zip(s.context.tolist(), s.predictive(model.rounds[-1]).tolist(), s.c.tolist(), s.t.tolist(), strict=True):
            total[u] += p
            customers[u] += c
            tables[u] += t
    known = {u for u in total if u < len(model.frequent)}
    end = int(model.of(np.array([lm.END]))[0])
    assert model.known == len(seen) + 1 and end >= 0
    # of a context all words but the end are asked for; where the end is seen as well, all are there
    for u in known:
        assert total[u] == pytest.approx(1, abs=0.05) and total[u] <= 1 + 1e-9
        assert customers[u] == model.customers[u] and tables[u] == model.rounds[-1].tables[u]
    assert any(total[u] == pytest.approx(1, abs=1e-9) for u in known)
    assert model.rounds[-1].root_customers == sum(tables.values())


@pytest.mark.parametrize(("c", "others", "p", "d"), [(5, 3, 0.2, 0.5), (4, 0, 0.01, 0.8), (8, 40, 0.6, 0.3)])
def test_tables_are_drawn_as_gibbs_sampling_seats(c, others, p, d):
    """Customers of one word leave and sit down again one by one, many times; the tables so found are distributed as those drawn."""
    rng, sizes, seen = random.Random(c), [c], Counter()
    for step in range(40_000):
        k = rng.choices(range(len(sizes)), sizes)[0]
        sizes[k] -= 1
        sizes = [s for s in sizes if s]
        weights = [s - d for s in sizes] + [(lm.THETA + d * (others + len(sizes))) * p]
        k = rng.choices(range(len(weights)), weights)[0]
        sizes = [*sizes, 1] if k == len(sizes) else [s + (i == k) for i, s in enumerate(sizes)]
        seen[len(sizes)] += step >= 1000
    n = 40_000
    t = lm.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, np.arange(n).astype(np.uint64), 7)
    drawn = Counter(t.tolist())
    for k in range(1, c + 1):
        assert drawn[k] / n == pytest.approx(seen[k] / 39_000, abs=0.025)


@pytest.mark.parametrize(("others", "p", "d"), [(10, 0.3, 0.6), (5000, 0.01, 0.5), (200, 0.9, 0.8), (0, 1e-4, 0.4)])
def test_many_customers_get_the_likeliest_tables(others, p, d):
    c = 1500
    ways = np.full(c + 2, -np.inf)
    ways[1] = 0.0
    for m in range(1, c):
        t = np.arange(1, c + 1)
        ways[1:-1] = np.logaddexp(ways[1:-1] + np.log(np.maximum(m - d * t, 1e-300)), ways[:-2])
    t = np.arange(1, c + 1)
    w = ways[1:-1] + np.cumsum(np.log(lm.THETA + d * (others + t - 1)) + np.log(p))
    w = np.exp(w - w.max())
    mean = (w * t).sum() / w.sum()
    deviation = np.sqrt((w * (t - mean) ** 2).sum() / w.sum())
    n = 200
    drawn = lm.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, np.arange(n).astype(np.uint64), 1)
    assert abs(drawn.mean() - mean) < 1 + 0.6 * deviation
    below = lm.draw_tables(np.full(4000, lm.EXACT), np.full(4000, others), np.full(4000, p), d, np.arange(4000).astype(np.uint64), 1).mean()
    above = lm.draw_tables(np.full(n, lm.EXACT + 1), np.full(n, others), np.full(n, p), d, np.arange(n).astype(np.uint64), 1).mean()
    assert abs(above - below) < 1 + 0.6 * deviation
    assert lm.draw_tables(np.array([0, 1, 10**12]), np.zeros(3, int), np.full(3, 0.5), d, np.arange(3).astype(np.uint64), 1)[:2].tolist() == [0, 1]


# --- vector codes


def plain_codes(rows, entries=256, rounds=4):
    kept = [(i, lab, [math.floor(1024 * x) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, _, v in kept), default=0) // 4) * 4
    kept = sorted(((i, lab, v + [0] * (width - len(v))) for i, lab, v in kept), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    k = width // 4
    books = [[v[p * k : (p + 1) * k] for _, _, v in kept[:entries]] for p in range(4)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds if kept else 0):
        for p in range(4):
            of = defaultdict(list)
            for _, _, v in kept:
                x = v[p * k : (p + 1) * k]
                of[near(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(of[j]) for c in zip(*of[j], strict=True)] if of[j] else e for j, e in enumerate(books[p])]
    found = [(i, lab, [near(v[p * k : (p + 1) * k], books[p]) for p in range(4)]) for i, lab, v in kept]
    errors = Counter()
    for _, lab, f in found:
        errors[lab] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), errors[lab], sha) for i, lab, f in found)


def codes_of(spark, rows, entries):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("id", "v", "code", "error", "p")}).repartition(3)
    coded, book = codes.compress(df, entries=entries)
    return sorted((str(r.id), r.code, r.error, r.label_error, codes.digest(book)) for r in codes.with_label_errors(coded).collect())


@pytest.mark.parametrize("seed", range(2))
def test_codes_against_plain_assignment(spark, seed):
    """Few distinct components make ties; ids and rows repeat; nulls, non-finite and short vectors; one label holds most rows."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, rng.randrange(60), 7]), [rng.randrange(-3, 4) / 2 - 0.001 * rng.randrange(2) for _ in range(rng.choice([6, 8]))], rng.choice([1, 1, 1, 2, None])) for _ in range(90)]
    rows += rows[:7] + [(5, None, 1), (6, [], None), (8, [None, 1.0], 2), (9, [float("nan")] * 8, 2), (10, [float("inf"), 0.0], 1)]
    assert codes_of(spark, rows, 16) == plain_codes(rows, 16)


def test_codes_of_few_rows_and_large_components(spark):
    rows = [(2, [1.5, -2.25, 0.0, 3.0], 1), (1, [1.5, -2.25, 0.0, 2.0], None)]
    assert codes_of(spark, rows, 256) == plain_codes(rows)
    assert codes_of(spark, [(1, [], 3)], 256) == plain_codes([(1, [], 3)])
    large = [(i, [float((-1) ** i * (1 << 15) + i), float(i), 0.0, -float(i << 13)], 1) for i in range(9)]
    assert codes_of(spark, large, 4) == plain_codes(large, 4)
    assert codes_of(spark, rows[:0], 256) == []
    with pytest.raises(ValueError, match="62 bits"):
        codes.compress(spark.createDataFrame([(1, [1e12], 1)], "vec_id long, embedding array<float>, label int"))


@pytest.mark.parametrize("exact", [True, False])
def test_equal_average_search_finds_the_lowest_nearest(exact):
    rng = np.random.default_rng(3)
    for n, e, k, spread in ((700, 256, 16, 900), (300, 64, 2, 3), (50, 1, 4, 5), (1, 7, 3, 2), (0, 5, 4, 9)):
        x, book = rng.integers(-spread, spread, (n, k)), rng.integers(-spread, spread, (e, k))
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        index, best = codes.nearest(x, book, exact)
        assert (best == d.min(1)).all() if n else not len(best)
        assert (index == d.argmin(1)).all() if n else not len(index)
