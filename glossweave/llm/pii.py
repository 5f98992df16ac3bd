"""Information-theoretic sanitisation of personal data.

Base entities (email, ip, card, phone) are found by their forms. Terms that stand near an entity can give it
away as well: over the whole corpus, n(t, e) documents have term t within `CONTEXT` words of entity e, n(t) have t
anywhere, n(e) have e, N are there. Knowing t yields PMI(t; e) = log2(n(t, e) N / (n(t) n(e))) of the
IC(e) = log2(N / n(e)) bits that identify e. The share PMI / IC is the term's disclosure: from `REMOVE` on the term is removed, from
`GENERALISE` on it is generalised. A term's classes are all words that begin like it, by `CLASSES` bytes, and their disclosure of e is counted
as the term's is; the narrowest class that does not disclose e takes the term's place (its beginning and *), or <term> if all do. A
pair needs `SUPPORT` documents. In a document that holds e near such a term, every occurrence of the term is treated.

Scale. The contexts are a few words for each entity found, so the pairs grow with the entities, not with documents
times words. n(t) is counted over all words of all documents, but only words and beginnings whose hash falls in a bucket of a
candidate leave the scan; the buckets are a bitmap sized by the candidates. A document meets only the
terms of its own contexts, by a hash of its text, so an entity that is in a third of all documents fans nothing out.
Texts without a digit or @ hold no base entity and take no part in the join.

Rows. Null text is empty: no spans. Null or repeated doc_id do not matter, rows are never matched by id.
Repeated rows count as often as they are there and all come back. Empty tables give no rows. Other columns pass through; one called `pii_spans`
gives way to the spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.llm.common import bitmap, in_bitmap, materialise, read_table, releasing, short_batches, small_batches, text_or_empty, unused, values_bytes
from glossweave.llm.words import HASH_BYTES, lower_ascii, mix, span_hashes, word_spans

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "generalise", "remove")
CONTEXT = 10
SUPPORT = 3
GENERALISE = 0.75
REMOVE = 0.95
#: Terms that a task counts before it sends their counts on.
COUNTED_AT_ONCE = 1 << 18
#: Bytes, up to the end of a character, with which the words of a class begin: narrow and wide.
CLASSES = (4, 2)
#: kept: the code points of the span that stay, before a *, where it is generalised to a class.
SPANS = "array<struct<kind:string,start:bigint,stop:bigint,kept:bigint>>"
SEEN = "th long, entity long, terms array<struct<term:bigint,narrow:bigint,wide:bigint>>"

#: The characters before an @, and the forms. Look-behinds keep every search linear and change no match.
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
MAY_HOLD = "[0-9@]"


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    twice = [int(c) for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) by kind as listed, then start, in code points."""
    out = [("email", *span) for span in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity_key(kind: str, found: str) -> int:
    import xxhash

    same = found.lower() if kind in ("email", "ip") else "".join(DIGITS.findall(found))
    return xxhash.xxh64_intdigest(f"{kind}:{same}") - (1 << 63)


def class_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Where each word's first `size` bytes end, moved on to the end of a character."""
    padded = np.r_[data, np.uint8(0)]
    out = np.minimum(starts + size, ends)
    for _ in range(3):
        out = np.minimum(out + ((padded[out] & 0xC0) == 0x80), ends)
    return out


def keyed_words(data: np.ndarray, offsets: np.ndarray):
    """(hashes, hashes of their classes, starts, ends, first word of each text) of words, A-Z as a-z. A class is no word, also where it is as long as one."""
    data = lower_ascii(data)
    starts, ends, firsts = word_spans(data, offsets)
    classes = [mix(span_hashes(data, starts, class_ends(data, starts, ends, size)) + np.uint64(size)) for size in CLASSES]
    return span_hashes(data, starts, ends), classes, starts, ends, firsts


def text_words(text: str):
    """(hashes, hashes of the classes, starts, stops, stops of the classes) of the words, in code points."""
    data = np.frombuffer(text.encode(), np.uint8)
    h, classes, starts, stops, _ = keyed_words(data, np.array([0, len(data)]))
    cuts = [class_ends(data, starts, stops, size) for size in CLASSES]
    if len(data) != len(text):
        # code points that begin before each byte
        points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        starts, stops, cuts = points[starts], points[stops], [points[c] for c in cuts]
    return h, classes, starts, stops, cuts


def free_words(spans, starts: np.ndarray, stops: np.ndarray):
    """(words that no base span touches and that are long enough to be terms, the words before and after each base span)."""
    free, where = np.ones(len(starts), bool), []
    for _, a, b in spans:
        i, j = np.searchsorted(stops, a, "right"), np.searchsorted(starts, b, "left")
        free[i:j] = False
        where.append((i, j))
    return free & (stops - starts >= 3), where


def contexts(text: str, spans, words):
    """For each base span its key and the places of the terms near it."""
    starts, stops = words[2:4]
    free, where = free_words(spans, starts, stops)
    for (kind, a, b), (i, j) in zip(spans, where, strict=True):
        near = np.r_[max(0, i - CONTEXT) : i, j : min(len(starts), j + CONTEXT)].astype(np.int64)
        yield entity_key(kind, text[a:b]), near[free[near]]


def _observe(batches):
    kind = pa.list_(pa.struct([("term", pa.int64()), ("narrow", pa.int64()), ("wide", pa.int64())]))
    for batch in small_batches(batches):
        texts, keys = batch.column("text"), batch.column("th").to_pylist()
        th, entity, terms = [], [], []
        for i, text in enumerate(texts):
            text = text.as_py()
            spans = base_spans(text)
            if not spans:
                continue
            words = text_words(text)
            near: dict[int, set] = {}
            h, (narrow, wide) = words[0].view(np.int64), [c.view(np.int64) for c in words[1]]
            for key, at in contexts(text, spans, words):
                near.setdefault(key, set()).update(zip(h[at].tolist(), narrow[at].tolist(), wide[at].tolist(), strict=True))
            for key, found in near.items():
                th.append(keys[i])
                entity.append(key)
                terms.append([{"term": t, "narrow": n, "wide": w} for t, n, w in sorted(found)])
        if th:
            yield pa.RecordBatch.from_arrays([pa.array(th, pa.int64()), pa.array(entity, pa.int64()), pa.array(terms, kind)], names=["th", "entity", "terms"])


def _key_counter(bits: bytes):
    """Documents by key, for the words and classes in the bitmap's buckets: a row for each key and task, or a few if there are very many."""

    def run(batches):
        counts = {}

        def emit():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["key", "n"])
            counts.clear()
            return out

        for batch in small_batches(batches, most=HASH_BYTES):
            words, classes, _, _, firsts = keyed_words(*values_bytes(batch.column("text")))
            doc = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
            for h in (words, *classes):
                hit = in_bitmap(bits, h)
                h, of = h[hit], doc[hit]
                order = np.lexsort((of, h))
                h, of = h[order], of[order]
                new = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])] if len(h) else np.zeros(0, bool)
                keys, n = np.unique(h[new], return_counts=True)
                for t, c in zip(keys.view(np.int64).tolist(), n.tolist(), strict=True):
                    counts[t] = counts.get(t, 0) + c
            if len(counts) >= COUNTED_AT_ONCE:
                yield emit()
        if counts:
            yield emit()

    return run


def disclosing_terms(docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """th (hash of a text), terms: array of (term, action, level), what to sanitise in that text; level: which class takes the term's place, 2 for none."""
    short_batches(docs.sparkSession)
    texts = docs.select(text_or_empty().alias("text")).withColumn("th", F.xxhash64("text"))
    total = docs.count()
    seen = materialise(texts.where(F.col("text").rlike(MAY_HOLD)).select("th", "text").mapInArrow(releasing(_observe), SEEN), "pii-contexts")
    with_entity = seen.groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = seen.select("entity", F.explode("terms").alias("t")).groupBy("entity", "t").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    pairs = materialise(pairs.select("entity", "t.*", "n"), "pii-pairs")
    # the classes of these terms: documents that have any of their words near the entity
    classes = pairs.select("entity", F.explode(F.array("narrow", "wide")).alias("key")).distinct()
    met = seen.select("entity", F.explode(F.array_distinct(F.concat(F.col("terms.narrow"), F.col("terms.wide")))).alias("key"))
    of_classes = met.join(classes, ["entity", "key"], "left_semi").groupBy("entity", "key").agg(F.count("*").alias("n"))
    near = materialise(pairs.select("entity", F.col("term").alias("key"), "n").unionByName(of_classes), "pii-near")
    bits = bitmap(near.select("key").distinct(), "key")
    counted = texts.select("text").mapInArrow(releasing(_key_counter(bits)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n_t"))
    bits_of_entity = F.log2(F.lit(float(total)) / F.col("n_e"))
    share = 1 + F.log2(F.col("n") / F.col("n_t")) / bits_of_entity
    shares = near.join(counted, "key").join(with_entity, "entity").where(bits_of_entity > 0).select("entity", "key", share.alias("share"))
    shares = materialise(shares, "pii-shares")
    named = lambda key: shares.select("entity", F.col("key").alias(key), F.col("share").alias(f"of_{key}"))
    judged = pairs.join(named("term"), ["entity", "term"]).where(F.col("of_term") >= generalise)
    judged = judged.join(named("narrow"), ["entity", "narrow"], "left").join(named("wide"), ["entity", "wide"], "left")
    level = F.when(F.col("of_narrow") < generalise, 0).when(F.col("of_wide") < generalise, 1).otherwise(2)
    flagged = judged.select("entity", "term", F.when(F.col("of_term") >= remove, "remove").otherwise("generalise").alias("action"), level.alias("level"))
    met = seen.distinct().select("th", "entity", F.explode("terms.term").alias("term")).join(flagged, ["entity", "term"])
    return met.groupBy("th", "term").agg(F.max("action").alias("action"), F.max("level").alias("level")).groupBy("th").agg(F.collect_list(F.struct("term", "action", "level")).alias("terms"))


def _all_spans(text: str, terms) -> list[tuple[str, int, int, int]]:
    spans = base_spans(text)
    out = [(*s, 0) for s in spans]
    if terms and spans:
        actions = {t["term"]: (t["action"], t["level"]) for t in terms}
        h, _, starts, stops, cuts = text_words(text)
        h, (free, _), found = h.view(np.int64), free_words(spans, starts, stops), []
        for k in np.flatnonzero(free & np.isin(h, list(actions))).tolist():
            action, level = actions[int(h[k])]
            kept = int(cuts[level][k] - starts[k]) if action == "generalise" and level < len(CLASSES) else 0
            found.append((action, int(starts[k]), int(stops[k]), kept))
        out += sorted(found, key=lambda x: (KINDS.index(x[0]), x[1]))
    return out


def _spans(terms_column: str):
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("kept", pa.int64())]))
        for batch in batches:
            texts, terms = batch.column(batch.schema.get_field_index("text")), batch.column(batch.schema.get_field_index(terms_column)).to_pylist()
            rows = [[dict(zip(("kind", "start", "stop", "kept"), s, strict=True)) for s in _all_spans(t.as_py() or "", terms[i])] for i, t in enumerate(texts)]
            keep = [n for n in batch.schema.names if n != terms_column]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in keep], pa.array(rows, kind)], names=[*keep, "pii_spans"])

    return run


def find(docs: DataFrame, **thresholds) -> DataFrame:
    """docs with pii_spans, an array of (kind, start, stop, kept): base entities, then disclosing terms."""
    docs = docs.drop("pii_spans")
    th, terms, key = unused(docs, "th", "terms", "key")
    may = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    found = disclosing_terms(docs, **thresholds).select(F.col("th").alias(th), F.col("terms").alias(terms))
    held = docs.where(may).withColumn(key, F.xxhash64("text"))
    joined = held.join(found, F.col(key) == F.col(th), "left").drop(key, th)
    schema = T.StructType([*docs.schema.fields, T.StructField("pii_spans", T.DataType.fromDDL(SPANS))])
    return joined.mapInArrow(releasing(_spans(terms)), schema).unionByName(docs.where(~may).withColumn("pii_spans", F.array().cast(SPANS)))


def _redacted(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda x: (x["start"], -x["stop"])):
        if s["stop"] <= at:
            continue
        start, kept = s["start"], int(s["kept"] or 0)
        shown = f"{text[start : start + kept]}*" if kept else f"<{s['kind']}>" if s["kind"] in BASE else "<term>" if s["kind"] == "generalise" else ""
        out += [text[at : max(at, start)], shown]
        at = s["stop"]
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, **thresholds) -> DataFrame:
    """docs with every span of find() replaced in its text: by its kind, by its class, or by nothing."""

    @F.pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        return pd.Series([_redacted(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    (held,) = unused(docs, "held")
    clash = [c for c in docs.columns if c.lower() == "pii_spans"]
    found = find(docs.withColumnRenamed(clash[0], held) if clash else docs, **thresholds)
    out = found.withColumn("text", F.when(F.size("pii_spans") > 0, cut("text", "pii_spans")).otherwise(F.col("text"))).drop("pii_spans")
    return out.withColumnRenamed(held, clash[0]) if clash else out


def op3_pii(spark, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")
    shown = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(shown(base), 256).alias("base_sha256"), shown(spans).alias("spans"))
