"""Operators that SQL does not express, against plain restatements on small inputs."""

import hashlib
import io
import itertools
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from glossweave.llm import bpe, common, media, neardup, pii, pretokens, quality, repeats, secrets, token_files, wavelet
from glossweave.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near_copies(rng):
    """Texts of which some are edits of others, in chains too, so that groups hold pairs that are not similar themselves."""
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(400)]
    texts = []
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        for _ in range(rng.choice([1, 2, 30])):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return texts + ["one two", "One TWO", "one two three"]


def test_near_duplicates_against_all_pairs(spark):
    texts = near_copies(random.Random(3))
    sets = []
    for t in texts:
        w = WORD.findall(t.lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 85 * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}


@pytest.mark.parametrize("n", range(8))
def test_few_words_in_a_batch(n):
    words = [f"w{i}" for i in range(n)]
    texts = ["", " ".join(words), " "]
    raw = [t.encode() for t in texts]
    got = neardup.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert [len(s) for s in got] == [0, max(1, n - 4) if n else 0, 0]


def test_long_lists_are_split_and_cut(spark, monkeypatch):
    """With tiny limits every list takes the long way; workers fork with the limits set here, so the kernels are run in place."""
    rng = random.Random(5)
    sig = [np.frombuffer(rng.randbytes(128), np.uint64) for _ in range(3)]
    post = np.arange(30, dtype=np.int32).reshape(3, 10)
    post[1] = post[0]
    found = neardup._collisions((post[:2], np.stack([sig[0], sig[0]])), (post[:2], np.stack([sig[0], sig[0]])), 0, None, True)
    assert found[:, :2].tolist() == [[0, 1]]
    # they have met in an earlier list
    assert not len(neardup._collisions((post[:1], sig[0][None]), (post[1:2], sig[0][None]), 1, None, False))
    # labels part only what is not connected
    side = (post[:2], np.stack([sig[0], sig[0]]))
    assert neardup._chosen(side, side, 0, None, True, (["a", "a"], ["a", "a"])) == []
    assert neardup._chosen(side, side, 0, None, True, (["a", "b"], ["a", "b"])) == [(0, 1)]


def test_components_against_search(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    loops = {a for a, b in edges if a == b}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(root[k] == v for k, v in got.items())
    assert set(root) - set(got) <= loops


@pytest.mark.parametrize("window", [8, 20])
def test_repeats_against_windows(spark, window):
    rng = random.Random(window)
    docs = []
    for _ in range(40):
        vocabulary = [chr(97 + i) for i in range(rng.choice([1, 2, 5, 26]))]
        docs.append([rng.choice(vocabulary) for _ in range(rng.randint(0, 90))])
    passage = [rng.choice("abcdefghijkl") + "x" for _ in range(window + 3)]
    for d in docs[::3]:
        i = rng.randint(0, len(d))
        d[i:i] = passage
    seen = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    expected = {}
    for k, d in enumerate(docs):
        gone = {j for i in range(len(d) - window + 1) if seen[tuple(d[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(w for i, w in enumerate(d) if i not in gone)
        expected[k] = (len(d), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.remove_repeats(df, window=window).collect()}
    assert got == expected


def test_pre_tokens_against_the_pattern():
    rng, find = random.Random(5), bpe.splitter().findall
    for letters in ("ab 's'tl'lremvd\n\t 12!?|éÀſ.", "a'sldrev l", "  \n\n a!1'"):
        for _ in range(1500):
            texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(5)]
            raw = [t.encode() for t in texts]
            offsets, data = np.cumsum([0, *map(len, raw)]), np.frombuffer(b"".join(raw), np.uint8)
            assert pretokens.plain_texts(data, offsets).all()
            starts = bpe.starts_of(data, offsets)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
            got = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
            assert got == [w for t in texts for w in find(t)]
            words, kind = pretokens.distinct_spans(data, starts, ends)
            assert words.take(pa.array(kind)).cast("string").to_pylist() == got and len(set(words.to_pylist())) == len(words)


def test_ids_against_the_libraries(spark):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    rng = random.Random(3)
    letters = "abZéÉ ' 't's'll  \n\t\x1c\x85\xa0 12²½Ⅷ١ñ漢ー́😀!?.,_-Σςİßẞǅŉªµ×÷<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(600)] + ["x<|endoftext|>y"]
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in bpe.token_bytes(bpe.rank_file()).items()}, special_tokens={})
    got = {r.doc_id: r.ids for r in bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    assert got == {i: whole.encode_ordinary(t) for i, t in enumerate(texts)}
    words = Tokenizer.from_file(token_files.tokenizer_file())
    for a, b in zip(token_files.encode_texts(token_files.tokenizer_file(), texts), words.encode_batch(texts, add_special_tokens=False), strict=True):
        assert a.tolist() == b.ids


def test_wavelet_matrix():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 70_000, 200_001):
        a = (rng.zipf(1.3, n) % 49_408).astype(np.uint16)
        out = io.BytesIO()
        wavelet.write_matrix(out, a, 16, [1], [n])
        m = wavelet.WaveletMatrix(out)
        assert (m.tokens() == a).all() and m.count(70_000) == 0
        for i in rng.integers(0, n, 15).tolist() if n else []:
            s = int(a[i])
            assert m.access(i) == s and m.count(s) == (a == s).sum()
            assert m.rank(s, i) == (a[:i] == s).sum() and m.select(s, int((a[:i] == s).sum())) == i
        with pytest.raises(IndexError):
            m.access(n)


def test_personal_data_forms():
    def plain(t):
        out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            digits = re.sub("[ -]", "", m[0])
            if 13 <= len(digits) <= 19 and pii.luhn(digits):
                out.append(("card", *m.span()))
        return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]

    rng = random.Random(1)
    for k in range(20_000):
        t = "".join(rng.choice("a@.b-+1 23(0)é_" if k % 2 else "0123456789 -+.") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == plain(t), t
    assert pii.luhn("4041894974608795") and not pii.luhn("4041894974608796")


def test_disclosing_terms(spark):
    """A word that stands by one address only is removed there, a common word never, and texts without an address stay."""
    docs = [(i, f"the common zanzibar ann@x.example.com words {i}") for i in range(5)] + [(10 + i, f"the common words {i} zanz") for i in range(60)]
    clean = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert clean[0] == "the common  <email> words 0" and clean[10] == "the common words 0 zanz"


def test_secret_forms():
    def plain(t):
        out = []
        for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
            out += [("assign", *m.span())] if len(m[1]) >= 6 else []
        out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        return out + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]

    rng, known = random.Random(2), secrets.compiled(secrets.RULES)
    parts = ["password", "TOKEN", "api_key", "apikey", "=", ":", " ", "'", '"', "abc123", "x" * 7, "AKIA", "AKIA" + "Z9" * 9, "0a" * 12, "0a" * 11, "é"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert [(k, a, b) for k in secrets.BASE for a, b in secrets.scan_text(t, *known[(k, 1)])] == plain(t), t


def test_marginals_and_held_out_accuracy(spark):
    rng = np.random.default_rng(0)
    firsts, u, pairs = np.array([0, 1, 4, 9]), rng.normal(size=9), rng.normal(size=(2, 2))
    p, counts, log_z = quality.marginals(u, firsts, pairs)
    for d in range(3):
        a, b = firsts[d], firsts[d + 1]
        total, mean, seen = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            s = np.exp(sum(u[a + i] * y[i] for i in range(b - a)) + sum(pairs[y[i], y[i + 1]] for i in range(b - a - 1)))
            total, mean = total + s, mean + s * np.array(y)
            for i in range(b - a - 1):
                seen[y[i], y[i + 1]] += s
        assert np.allclose(p[a:b], mean / total) and np.allclose(counts[d], seen / total) and np.isclose(log_z[d], np.log(total))
    sf = "/root/testdata/sf0.01"
    labels = common.read_table(spark, sf, "labels")
    got = quality.op6_quality(spark, sf).where("held_out").join(labels, "doc_id").select("quality", "predicted").collect()
    assert len(got) > 50 and sum(r.quality == r.predicted for r in got) >= 0.95 * len(got)


def test_members_are_retried_alone():
    text = io.BytesIO()
    with zipfile.ZipFile(text, "w") as z:
        for i in range(3):
            z.writestr(f"{i}.0.png", media.to_png(media.payload_of(bytes([65 + i]) * 700)))
    whole, tries = text.getvalue(), Counter()

    class Flaky(io.BytesIO):
        """The second member is damaged in the first two handles that reach it."""

        def seek(self, at, *how):
            self.at = at
            return super().seek(at, *how)

        def read(self, n=-1):
            data = super().read(n)
            if n == 30:
                tries[self.at] += 1
            return data if n == 30 or tries[info[1].header_offset] > 2 or self.at < info[1].header_offset or self.at >= info[2].header_offset else data[:-1] + b"!"

    with zipfile.ZipFile(io.BytesIO(whole)) as z:
        info = z.infolist()
    for i, m in enumerate(info):
        assert media.from_png(media.fetch_member(lambda _: Flaky(whole), "x", m, wait=0)).rstrip(b"\xff") == bytes([65 + i]) * 700
    assert [tries[m.header_offset] for m in info] == [1, 3, 1]
    tries.clear()
    with pytest.raises(OSError):
        media.fetch_member(lambda _: Flaky(whole), "x", info[1], tries=2, wait=0)


def test_media_of_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in media.op1_media(spark, sf).collect()}
    for d in common.read_table(spark, sf, "documents").collect():
        raw = (d.text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        r = got[d.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs, columns = common.read_table(spark, sf, "documents"), None
    columns = docs.columns
    kept = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = common.materialise(stage(spark, docs, sf), "stage")
        if i < 4:
            assert docs.columns == columns
        kept.append(docs.count())
    assert kept[0] > kept[1] > kept[2] == kept[3] and kept[4] == kept[5]
    for r in docs.limit(50).collect():
        table = bpe.token_bytes(bpe.rank_file())
        assert hashlib.sha256(b"".join(table[i] for i in r.ids)).hexdigest() == r.decoded_sha256
