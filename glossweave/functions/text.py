"""Column functions on sentences, tokens and tags."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.config import JA_INDEPENDENT, JA_NOUN_SUFFIXES, POS_NAMES, TAG_MAPS

TOKEN = r"[\p{L}\p{N}]+|[^\s]"


def strip_marks(c: Column) -> Column:
    """Without @ signs."""
    return F.replace(c, F.lit("@"), F.lit(""))


def strip_newlines(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(""))


def strip_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def widen_space(c: Column) -> Column:
    """ASCII spaces as full-width ones."""
    return F.replace(c, F.lit(" "), F.lit("　"))


def tokenize(c: Column) -> Column:
    """Words and single other marks, in order."""
    return F.regexp_extract_all(c, F.lit(TOKEN), 0)


def pos_name(c: Column) -> Column:
    """The name of a code; null for any other."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in POS_NAMES.items() for x in pair]), c)


def tag_code(c: Column, tag_set: str, compat: bool = False) -> Column:
    """The code of a tag in a tag set; "" where it has none."""
    out = F.lit("")
    for code, tags in TAG_MAPS[tag_set].items():
        out = F.when(c.isin(*tags), code).otherwise(out)
    return out


def tokens(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """One row for each token of a sentence: keep, idx from 0, word."""
    return df.select(*keep, F.posexplode(tokenize(strip_marks(F.col(column)))).alias("idx", "word"))


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings of spans of UTF-8 bytes."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes()))


def distinct_rows(columns: list[pa.Array]) -> tuple[list[tuple], np.ndarray]:
    """(the distinct rows of some string columns, the place of each row among them)."""
    code = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        coded = column.fill_null("").dictionary_encode()
        _, code = np.unique(code * np.int64(max(1, len(coded.dictionary))) + coded.indices.to_numpy(), return_inverse=True)
    _, first, place = np.unique(code, return_index=True, return_inverse=True)
    take = pa.array(first)
    return list(zip(*[c.fill_null("").take(take).to_pylist() for c in columns], strict=True)), place


def folded(toks: Column, fields: tuple[str, ...], features, step, code_of) -> Column:
    """array of (word, pos) that a fold makes of each row's tokens, structs with these fields, of which the first is the surface.

    features: what of a token's fields the fold looks at, made once for each distinct token of a batch. step(begun, pos, last, *features) looks at whether a word is open,
    its code, and what the last token says of the next; it gives (goes on, pos, last), or None for a row that fails and becomes null. As a state and features
    are few, a step is made once for each pair of them and then looked up; a word is a span of its sentence's surfaces, so none is joined.
    """

    @F.arrow_udf("array<struct<word:string,pos:string>>")
    def fold(rows: pa.Array) -> pa.Array:
        valid = np.asarray(rows.is_valid())
        sizes = np.where(valid, np.diff(np.asarray(rows.offsets)), 0)
        flat = rows.flatten()
        columns = [flat.field(flat.type.get_field_index(f)) for f in fields]
        tokens, place = distinct_rows(columns)
        kinds: dict = {}
        kind_of = np.array([kinds.setdefault(features(*t), len(kinds)) for t in tokens], np.int64)
        kind, kinds = kind_of[place].tolist(), list(kinds)
        states, known, steps = [(False, "", "")], {(False, "", ""): 0}, {}
        starts, ends, codes, counts, at = [], [], [], [0], 0
        for row, size in enumerate(sizes.tolist()):
            state, begun = 0, len(starts)
            for i in range(at, at + size):
                key = state, kind[i]
                if key not in steps:
                    found = step(*states[state], *kinds[kind[i]])
                    if found is not None:
                        found = found[0], known.setdefault((True, *found[1:]), len(known))
                        states.extend(list(known)[len(states) :])
                    steps[key] = found
                found = steps[key]
                if found is None:
                    valid[row] = False
                    break
                if not found[0]:
                    if state:
                        ends.append(i)
                        codes.append(states[state][1])
                    starts.append(i)
                state = found[1]
            if not valid[row]:
                del starts[begun:], ends[begun:], codes[begun:]
            elif state:
                ends.append(at + size)
                codes.append(states[state][1])
            at += size
            counts.append(len(starts))
        surface = columns[0].fill_null("")
        offsets = np.frombuffer(surface.buffers()[1], np.int32)[surface.offset : surface.offset + len(surface) + 1].astype(np.int64)
        data = np.frombuffer(surface.buffers()[2] or b"", np.uint8)
        words = gathered(data, offsets[np.array(starts, np.int64)], offsets[np.array(ends, np.int64)]) if starts else pa.array([], pa.string())
        named = {p: code_of(p) for p in set(codes)}
        structs = pa.StructArray.from_arrays([words, pa.array([named[p] for p in codes], pa.string())], names=["word", "pos"])
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), structs, mask=pa.array(~valid))

    return fold(toks)


def merged_zh(toks: Column, compat: bool = False) -> Column:
    """Glues prefixes, suffixes and the particle to their neighbours. toks: array of (word, pos).

    After a prefix the next token is glued and gives its code; a suffix is glued and the code stays; the particle is
    glued and makes an adjective, and does not end a prefix. A sentence that begins with either starts a token
    (compat: yields null, the row's failure). A prefix left at the end counts as a function word (compat: stays).
    """

    def step(begun, pos, last, kind):
        if kind in ("suffix", "de"):
            if not begun:
                return None if compat else (False, "", "")
            return (True, "a", last) if kind == "de" else (True, pos, pos)
        return last == "prefix", kind, kind

    return folded(toks, ("word", "pos"), lambda word, kind: (kind,), step, lambda pos: "" if pos == "prefix" and not compat else pos)


def merged_ja(mrphs: Column) -> Column:
    """Glues morphemes to words and maps classes to codes. mrphs: array of (midasi, hinsi, bunrui, katuyou1, katuyou2, genkei)."""
    suffixes, codes = set(JA_NOUN_SUFFIXES), {kind: code for code, kinds in TAG_MAPS["ja"].items() for kind in kinds}

    def features(midasi, hinsi, bunrui, katuyou1, katuyou2, genkei):
        return midasi in suffixes, hinsi, bunrui, katuyou1, katuyou2, genkei == "する"

    def step(begun, pos, last, suffix, hinsi, bunrui, katuyou1, katuyou2, suru):
        if not begun:
            return False, hinsi, katuyou2
        if suffix and (pos == "名詞" or last == "語幹"):
            return True, pos, ""
        if hinsi == "接尾辞" and bunrui != "動詞性接尾辞":
            return True, bunrui[: max(len(bunrui) - 6, 0)], ""
        if suru and hinsi == "動詞" and katuyou1 == "サ変動詞" and pos in JA_INDEPENDENT:
            return True, "動詞", katuyou2
        if hinsi == "名詞" and pos == "接頭辞":
            return True, "名詞", katuyou2
        if hinsi in ("名詞", "動詞") and hinsi == pos:
            return True, pos, katuyou2
        return False, hinsi, katuyou2

    return folded(mrphs, ("midasi", "hinsi", "bunrui", "katuyou1", "katuyou2", "genkei"), features, step, lambda pos: codes.get(pos, ""))


def shown_tokens(toks: Column) -> Column:
    """word:pos, with N/A for function words, joined by spaces."""
    return F.array_join(F.transform(toks, lambda t: F.concat(t["word"], F.lit(":"), F.when(t["pos"] == "", "N/A").otherwise(t["pos"]))), " ")


def shown_paths(paths: Column) -> Column:
    """array of (cost, line) of paths, as lattice.Lattice gives them, whose words and codes are not null: the lines as shown_tokens gives them, made for a batch of rows where the paths are."""

    @F.arrow_udf("array<struct<cost:bigint,line:string>>")
    def shown(rows: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        each = rows.flatten()
        words = each.field("words")
        counts, toks = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False), words.flatten()
        code = toks.field("pos")
        marked = pc.binary_join_element_wise(toks.field("word"), pc.if_else(pc.equal(code, ""), "N/A", code), ":")
        lists = lambda n, values, mask=None: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), values, mask=mask)
        lines = pc.binary_join(lists(counts, marked), " ")
        return lists(sizes, pa.StructArray.from_arrays([each.field("cost"), lines], names=["cost", "line"]), pa.array(~np.asarray(rows.is_valid())))

    return shown(paths)
