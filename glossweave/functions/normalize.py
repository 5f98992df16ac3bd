"""Column functions that bring a word to its listed form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def norm_zh(c: Column) -> Column:
    """Without one particle at the end."""
    return F.regexp_replace(c, "的$", "")


def norm_ko(word: Column, pos: Column, morphs: Column) -> Column:
    """morphs: array of (morph, tag). Adjectives and verbs keep stems and end in 다; others stay."""
    stem = lambda m: m["tag"].rlike("^(VV|VA|VX|X|NNG|NNP)") | ((pos == "v") & m["tag"].startswith("MAG"))
    joined = F.array_join(F.transform(F.filter(morphs, stem), lambda m: m["morph"]), "")
    ended = F.when((joined != "") & ~joined.endswith("다"), F.concat(joined, F.lit("다"))).otherwise(joined)
    return F.when(pos.isin("a", "v"), ended).otherwise(word)


def norm_ja(pos: Column, mrphs: Column) -> Column:
    """(norm, matched) of a word's morphemes: array of (midasi, repname, hinsi, bunrui, katuyou1, genkei).

    Morphemes before the last give their surface, nouns their standard form. The last gives its standard or base form if
    its class is that of pos; otherwise its surface, but its base form for nouns. Adjectives of the na kind lose だ or な.
    """
    has = lambda m: m["repname"].contains("/")
    front = lambda m: F.split_part(m["repname"], F.lit("/"), F.lit(1))
    first = F.transform(F.slice(mrphs, 1, F.greatest(F.size(mrphs) - 1, F.lit(0))), lambda m: F.when((m["hinsi"] == "名詞") & has(m), front(m)).otherwise(m["midasi"]))
    last = F.try_element_at(mrphs, F.lit(-1))
    base = F.when(has(last), front(last)).otherwise(last["genkei"])
    kind = F.element_at(F.create_map(*[F.lit(x) for x in ("a", "形容詞", "v", "動詞", "r", "副詞", "n", "名詞")]), pos)
    matched = F.coalesce(last["hinsi"].contains(kind) | last["bunrui"].contains(kind), F.lit(False))
    trimmed = F.when((pos == "a") & last["katuyou1"].contains("ナ") & base.rlike("[だな]$"), F.regexp_replace(base, ".$", "")).otherwise(base)
    end = F.when(matched, trimmed).when(pos == "n", base).otherwise(last["midasi"])
    norm = F.when(F.size(mrphs) > 0, F.concat(F.array_join(first, ""), end)).otherwise("")
    return F.struct(norm.alias("norm"), matched.alias("matched"))


#: The class that each code stands for.
JA_CLASSES = {"n": "名詞", "v": "動詞", "a": "形容詞", "r": "副詞"}
JA_FORMS = T.ArrayType(T.StructType([T.StructField("pos", T.StringType()), T.StructField("norm", T.StringType()), T.StructField("matched", T.BooleanType())]))


def norm_ja_batch(morphemes: dict[str, pa.Array], place: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """What norm_ja makes of each row's morphemes under each of n, v, a and r: JA_FORMS.

    morphemes: midasi, repname, hinsi, bunrui, katuyou1 and genkei of the distinct ones, each looked at once; place: the one of each morpheme of all rows; sizes: how many a row has.
    """
    midasi, repname, hinsi, bunrui, katuyou1, genkei = (morphemes[f] for f in ("midasi", "repname", "hinsi", "bunrui", "katuyou1", "genkei"))
    has, front = pc.match_substring(repname, "/"), pc.replace_substring_regex(repname, "(?s)/.*", "")
    base = pc.if_else(has, front, genkei)
    trimmed = pc.if_else(pc.match_substring(katuyou1, "ナ"), pc.replace_substring_regex(base, "[だな]$", ""), base)
    parts = pc.if_else(pc.and_(pc.equal(hinsi, "名詞"), has), front, midasi)
    some = sizes > 0
    last = np.zeros(len(place), bool)
    last[(np.cumsum(sizes) - 1)[some]] = True
    begun = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.maximum(sizes - 1, 0))]).astype(np.int32)), parts.take(pa.array(place[~last])))
    begun, norms, matches = pc.binary_join(begun, ""), [], []
    # a row without morphemes has an empty norm
    of = np.full(len(sizes), len(midasi))
    of[some] = place[last]
    for pos, kind in JA_CLASSES.items():
        matched = pc.or_(pc.match_substring(hinsi, kind), pc.match_substring(bunrui, kind))
        ends = pc.if_else(matched, trimmed if pos == "a" else base, base if pos == "n" else midasi)
        norms.append(pc.binary_join_element_wise(begun, pa.concat_arrays([ends, pa.array([""])]).take(pa.array(of)), ""))
        matches.append(np.append(np.asarray(matched), False)[of])
    n, k = len(sizes), len(JA_CLASSES)
    turn = np.arange(n * k).reshape(k, n).T.ravel()
    codes = pa.array(list(JA_CLASSES), pa.string()).take(pa.array(np.tile(np.arange(k), n)))
    structs = pa.StructArray.from_arrays([codes, pa.concat_arrays(norms).take(pa.array(turn)), pa.array(np.concatenate(matches)[turn])], names=["pos", "norm", "matched"])
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k).astype(np.int32)), structs)


#: Analyses of a phrase that are looked at.
RANKS = 5


def norm_ja_ranked(word: Column, pos: Column, ranked: Column) -> Column:
    """The form of a phrase with ranked analyses: array of the morphemes of each, as norm_ja takes them.

    The first whose last morpheme is of the class of pos counts, of the first RANKS and before one that is empty; without such, that of the first.
    """
    forms = F.transform(F.slice(ranked, 1, RANKS), lambda m: F.struct((F.size(m) == 0).alias("gap"), norm_ja(pos, m).alias("n")))
    first = F.get(forms, F.lit(0))["n"]["norm"]
    hit = F.filter(forms, lambda x: x["gap"] | x["n"]["matched"])
    return F.coalesce(F.when(~F.get(hit, F.lit(0))["gap"], F.get(hit, F.lit(0))["n"]["norm"]), first, F.lit(""))
