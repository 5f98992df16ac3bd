"""op6's score restated line by line, with all labellings of a text enumerated."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from glossweave.llm import common, quality

SF = "/root/testdata/sf0.001"


def plain_lines(text):
    """(features, bytes) of each line that is not blank; one empty line without such."""
    spans = []
    for line in text.encode().split(b"\n"):
        words = re.findall(rb"[^\x20\x09-\x0D]+", line)
        if words:
            spans.append((line[line.index(words[0]) : line.rindex(words[-1]) + len(words[-1])], words))
    out = []
    for span, words in spans:
        letter = lambda c: c >= 128 or chr(c).isalpha()
        n, k = len(span), len(words)
        count = lambda f, span=span: sum(map(f, span))
        ascii_ = lambda f: lambda c: c < 128 and f(chr(c))
        out.append(([
            math.log1p(n) / 5, count(ascii_(str.isupper)) / max(1, count(letter)), count(ascii_(str.isdigit)) / n, count(ascii_(lambda s: s > " " and not s.isalnum())) / n,
            count(ascii_(lambda s: s in "#$%&*^~<>{}[]\\/=_|@")) / n, count(ascii_(lambda s: s in "!?")) / n, count(ascii_(lambda s: s <= " ")) / n, n / k / 10, len(set(words)) / k,
            sum(a == b for a, b in zip(words, words[1:])) / k, sum(not letter(w[-1]) for w in words) / k, span[-1:] in b".!?", sum(s == span for s, _ in spans) > 1, count(lambda c: c >= 128) / n, k == 1,
        ], n))
    return out or [([0.0] * 15, 0)]


def plain_score(model, text):
    lines = plain_lines(text)
    z = [(np.array(x, float) - model.mean) / model.scale for x, _ in lines]
    none = np.zeros(15)
    unary = [float(np.concatenate([z[i], z[i - 1] if i else none, z[i + 1] if i + 1 < len(z) else none, [1.0]]) @ model.weights) for i in range(len(z))]
    total, good = 0.0, np.zeros(len(z))
    for y in itertools.product((0, 1), repeat=len(z)):
        s = math.exp(sum(u for u, v in zip(unary, y, strict=True) if v) + sum(model.pairs[a, b] for a, b in zip(y, y[1:])))
        total, good = total + s, good + s * np.array(y)
    weight = np.array([n + 1.0 for _, n in lines])
    raw = min(max(float((good / total * weight).sum() / weight.sum()), 1e-6), 1 - 1e-6)
    return 1 / (1 + math.exp(-(model.curve[0] * math.log(raw / (1 - raw)) + model.curve[1])))


def test_score_against_enumerated_labellings(spark):
    model = quality.train(common.read_table(spark, SF, "documents"), common.read_table(spark, SF, "labels"))
    rng = random.Random(8)
    parts = ["The", "word", "word", "é漢", "12", "a!", "x_y|", "END.", "\t", "  ", "(q)", "\x7f", "ÄB", "why?"]
    texts = ["", " \n\n", "one"] + ["\n".join(" ".join(rng.choices(parts, k=rng.randrange(8))) for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    texts.append("same line\nother\nsame line\n same line ")
    df = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.quality_score for r in quality.score(df, model).collect()}
    for i, text in enumerate([*texts, ""]):
        assert got[i] == pytest.approx(plain_score(model, text), abs=1e-9), text
