"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by its content (SHA-256). The ledger is two tables in
a folder: `scanned`, the pairs (blob, rule, version) that are done, and `findings`. A run takes the blobs of all given
versions, leaves the pairs that the ledger has, reads one copy of each blob that is left, scans it with the
rules that are left, and appends. Then all findings are joined back to all versions. A new version of a
rule is scanned over all blobs; a new document only with what it adds.

Findings are appended before the pairs that they come from, so a run that dies in between scans again, and
reading drops what is there twice. Blobs are few bytes in every shuffle but one: the texts move once, dealt by path and blob,
and only one row of a blob goes on, so that copies are neither scanned nor gathered. In the join back a blob that more than one in `HOT`
versions hold is dealt to `SALT` tasks; there are fewer than `HOT` such blobs, and only their findings are repeated.

Rows. Null text is scanned as empty. A null path is a path. Repeated rows are one version each and all come back.
Empty tables give no rows. Columns beside path and text pass through; one called `found` gives way to the findings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import materialise, read_table, releasing, shared_dir, small_batches, text_or_empty, unused

#: Kind, version, pattern, least length of a group, the group. The first three are the base.
RULES = (
    ("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", 1, r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}", 24, 0),
    ("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 40, 0),
    ("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0),
)
BASE = ("assign", "access", "hex")
#: A blob is hot if more than one in so many versions hold it; its versions are dealt to so many tasks.
HOT, SALT = 1000, 64
SCHEMA = "blob binary, rule string, version int, start long, stop long"


def compiled(rules) -> dict:
    """ASCII matching only: letters of other alphabets never fold onto a-z."""
    return {(k, v): (re.compile(p, re.ASCII | (re.IGNORECASE if k == "assign" else 0)), least, group) for k, v, p, least, group in rules}


def scan_text(text: str, pattern: re.Pattern, least: int, group: int) -> Iterator[tuple[int, int]]:
    for m in pattern.finditer(text):
        if m.end(group) - m.start(group) >= least:
            yield m.span()


#: What a text must hold, in lower case for assign, for its pattern to match at all (fixed values).
HINTS = {"assign": ("passw", "secret", "token", "api"), "access": ("AKIA",), "github": ("gh",), "private_key": ("-----BEGIN ",)}


def scanner(rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        patterns = compiled(rules)
        long_hex = pa.scalar("[0-9a-f]{24}")
        for batch in small_batches(batches):
            texts, blobs, wanted = batch.column("text"), batch.column("blob"), batch.column("rules").to_pylist()
            folded = pc.ascii_lower(texts)
            may = {}
            for kind, _ in patterns:
                if kind in HINTS:
                    of = folded if kind == "assign" else texts
                    hits = [pc.match_substring(of, hint).to_numpy(zero_copy_only=False) for hint in HINTS[kind]]
                    may[kind] = sum(hits[1:], hits[0])
                elif kind == "hex":
                    may[kind] = pc.match_substring_regex(texts, long_hex.as_py()).to_numpy(zero_copy_only=False)
            found = []
            for i, pairs in enumerate(wanted):
                todo = [(r["rule"], r["version"]) for r in pairs if r["rule"] not in may or may[r["rule"]][i]]
                if todo:
                    text, blob = texts[i].as_py(), blobs[i].as_py()
                    found += [(blob, *key, a, b) for key in todo for a, b in scan_text(text, *patterns[key])]
            if found:
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())], names=["blob", "rule", "version", "start", "stop"])

    return run


class Ledger:
    """The folder that says which blobs have been scanned with which version of which rule."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str, schema: str) -> DataFrame:
        """The table, or none of its rows while nothing has been written."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self.table("scanned", "blob binary, rule string, version int")

    def findings(self) -> DataFrame:
        return self.table("findings", SCHEMA).distinct()

    def add(self, versions: DataFrame, rules=RULES) -> None:
        """Scans what versions (path, text) hold and the ledger has not."""
        texts = versions.select("path", text_or_empty().alias("text"))
        addressed = texts.select(F.unhex(F.sha2("text", 256)).alias("blob"), F.struct(F.col("path").isNull().alias("none"), "path").alias("owner"))
        owners = addressed.groupBy("blob").agg(F.min("owner").alias("owner"))
        pairs = F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(v).cast("int").alias("version")) for k, v, *_ in rules])
        todo = owners.withColumn("pair", F.explode(pairs)).select("blob", "owner", "pair.rule", "pair.version").join(self.scanned(), ["blob", "rule", "version"], "left_anti")
        # dealt by blob already: the groups need no further shuffle and have a row for each rule at most
        todo = materialise(todo.groupBy("blob").agg(F.first("owner.path").alias("_path"), F.collect_list(F.struct("rule", "version")).alias("rules")), "ledger-todo")
        wanted = texts.withColumn("_blob", F.unhex(F.sha2("text", 256))).join(todo.hint("shuffle_hash"), F.col("path").eqNullSafe(F.col("_path")) & (F.col("_blob") == F.col("blob")))
        found = wanted.select("blob", "text", "rules").mapInArrow(releasing(scanner(rules)), SCHEMA)
        found.distinct().write.mode("append").parquet(f"{self.path}/findings")
        todo.select("blob", F.explode("rules").alias("r")).select("blob", "r.rule", "r.version").write.mode("append").parquet(f"{self.path}/scanned")

    def report(self, versions: DataFrame, rules=RULES) -> DataFrame:
        """versions with `found`, an array of (start, place, stop, rule) in order; place is the rule's place in rules."""
        known = F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(v).cast("int").alias("version")) for k, v, *_ in rules])
        place = F.array_position(known, F.struct("rule", "version"))
        kept = self.findings().withColumn("place", place).where("place > 0")
        grouped = kept.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "place", "stop", "rule"))).alias("found"))
        versions = versions.drop("found")
        key, deal, blob, salt, salts = unused(versions, "key", "deal", "blob", "salt", "salts")
        addressed = versions.withColumn(key, F.unhex(F.sha2(text_or_empty(), 256)))
        held = materialise(addressed.groupBy(F.col(key).alias(blob)).agg(F.count("*").alias("n")), "ledger-held")
        total = held.agg(F.sum("n")).first()[0] or 0
        hot = held.where(F.col("n") * HOT > total).select(blob, F.lit(SALT).alias(salts))
        dealt = addressed.join(F.broadcast(hot), F.col(key) == F.col(blob), "left").drop(blob)
        dealt = dealt.withColumn(deal, F.pmod(F.monotonically_increasing_id(), F.coalesce(salts, F.lit(1))).cast("int")).drop(salts)
        salted = grouped.withColumnRenamed("blob", blob).join(F.broadcast(hot), blob, "left")
        salted = salted.withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1))).drop(salts)
        return dealt.join(salted, (F.col(key) == F.col(blob)) & (F.col(deal) == F.col(salt)), "left").drop(key, deal, blob, salt)


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents as versions that arrive in two deliveries, a new ledger, the findings of each document.

    The second delivery is scanned only for blobs that the first has not brought.
    """
    versions = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger = Ledger(spark, shared_dir(spark, "ledger"))
    early = F.coalesce(F.crc32(F.col("path").cast("string")) % 2 == 0, F.lit(True))
    ledger.add(versions.where(early))
    ledger.add(versions.where(~early))
    found = F.coalesce(F.col("found"), F.array().cast("array<struct<start:bigint,place:int,stop:bigint,rule:string>>"))
    shown = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["rule"], x["start"], x["stop"])), ",")
    base = F.filter(found, lambda x: x["rule"].isin(*BASE))
    count = lambda kind: F.size(F.filter(found, lambda x: x["rule"] == kind)).cast("long").alias(f"n_{kind}")
    return ledger.report(versions).select(F.col("path").alias("doc_id"), *[count(k) for k in BASE], F.sha2(shown(base), 256).alias("base_sha256"), shown(found).alias("spans"))
