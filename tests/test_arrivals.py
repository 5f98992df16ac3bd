"""The stream's alignment of a batch in one task, against column functions."""

import os

import pytest
from pyspark.sql import functions as F

from glossweave.functions.text import tokenize
from glossweave.operators import align as al
from glossweave.plans import inputs, jobs, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_facts_of_rows_whose_words_are_classed_in_batches(spark, monkeypatch):
    docs = inputs.corpus(spark, SF).where("row_pos < 60 * 1048576").select("row_pos", "id", "s1", "s2")
    rows = docs.unionByName(spark.createDataFrame([(-1, "x", None, "big dogs"), (-2, "y", "big dogs", None), (-3, "z", "", "")], docs.schema)).localCheckpoint()
    listed, vectors = inputs.word_list(spark, SF), inputs.vectors(spark, SF)
    language, n = jobs.by_lexicon(inputs.lexicon_code, lambda phrase, pos: inputs.lemma_of(phrase)), vectors.count()
    excepted = spark.createDataFrame([], "norm1 string, norm2 string")
    of = lambda encode: jobs.Setup(inputs.CONFIG, (language, language), encode, (listed, listed), excepted)
    found = lambda facts: sorted(map(tuple, facts.select("row_pos", "seq", "id", "pos", "id1", "word1", "id2", "word2").collect()))
    facts, failed = jobs.aligned(rows, of(jobs.word_encoder(vectors, lambda w: inputs.vector_of(inputs.digest(w), F.lit(n)))))
    expected, bad = found(facts), sorted(map(tuple, failed.collect()))
    assert len(expected) > 50 and [r[0] for r in bad] == [-2, -1]
    for size in (al.VECTOR_BYTES, 0):
        monkeypatch.setattr(al, "VECTOR_BYTES", size)
        facts, failed = jobs.aligned(rows, of(jobs.Batched(tokenize, vectors, inputs.word_step)))
        assert found(facts) == expected and sorted(map(tuple, failed.collect())) == bad


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_an_arrival_of_the_stream_is_no_single_task(spark, monkeypatch):
    parts, write = [], queries.files.write_csv

    def seen(df, path, mode="errorifexists"):
        if "stream-source" in path:
            parts.append(df.rdd.getNumPartitions())
        write(df, path, mode)

    monkeypatch.setattr(queries.files, "write_csv", seen)
    queries.stream_counts(spark, SF)
    assert len(parts) == 2 and min(parts) > 1
