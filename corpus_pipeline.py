"""From raw documents to token ids: five stages, each over all that the one before kept.

run(spark, sf_dir) writes each stage's documents as Parquet to the shared folder and reads them again for the next.

Rows. A null text counts as empty in every stage: it gets a quality of its own, has no near-duplicate, nothing to replace, a size of 0 words and no tokens.
Null ids, languages and sources are values like others. Repeated rows, alike in id and text, leave one; of a group of near-duplicates the row of the least id stays. Ties in the mix
are drawn by a hash of id and text, so they fall alike in each run, and rows alike in both are taken alike. Columns beside those of `documents` go along up to the last
stage, whatever they are called, but for `quality_score`. An empty table, or one of which no document is good, gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.llm.bpe import decode, encode
from glossweave.llm.common import materialise, read_table, scratch, shared_dir
from glossweave.llm.mixing import mixed
from glossweave.llm.neardup import keep_one
from glossweave.llm.pii import redact
from glossweave.llm.quality import score, train


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model rates bad go."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).where("quality_score >= 0.5").select(*docs.columns)


#: The similarity, as a share of 100, from which two documents are near-duplicates here; op2 has a contract of its own.
NEAR = 80


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one(docs, NEAR)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced or removed; n_chars follows."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document that it takes twice is there twice."""
    return mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids; decoded_sha256 is of the bytes that they decode to."""
    found = decode(encode(docs, keep=("doc_id", "lang", "source", "n_chars")))
    return found.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: SQL has neither the model nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. What a stage wrote on the way is removed when its own documents are written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        with scratch(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, path)
    return docs
