"""Tables between the steps of a job, row numbers, and joins whose broadcast is checked."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a stored lookup table up to which it is broadcast; beyond, Spark shuffles by the key.
BROADCAST_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir; a local master without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="glossweave-")
    return f"{base.rstrip('/')}/glossweave/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """df as a table in the shared folder, written with these options; what follows starts there."""
    path = work_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def stored_bytes(df: DataFrame) -> int:
    """Bytes of a table that stored() gave."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(df.stored_at)
    return place.getFileSystem(conf).getContentSummary(place).getLength()


def lookup(left: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Joins a lookup table, which is stored first, so that it is made once; it is broadcast only if what was stored is small, and else joined by split_join."""
    if not hasattr(table, "stored_at"):
        table = stored(table, "lookup")
    if stored_bytes(table) <= BROADCAST_BYTES:
        return left.join(F.broadcast(table), keys, how)
    return split_join(left, table, keys, how)


def _hash_of(df: DataFrame, other: DataFrame, keys: list[str]) -> Column:
    """A hash of the keys that is the same for both sides."""
    same = [df.schema[k].dataType == other.schema[k].dataType for k in keys]
    return F.xxhash64(*[F.col(k) if s else F.col(k).cast("string") for k, s in zip(keys, same, strict=True)])


def hot_hashes(df: DataFrame, keys: Column, parts: int) -> list[int]:
    """Hashes of the keys that hold more than a quarter of a task's even share of the rows, for so many tasks.

    From a summary of heavy hitters, which tasks make of their rows and Spark merges: its size does not follow the rows or the keys, and what it says
    of a key's rows is at most too much, by a small share of a task.
    """
    most = min(4 * parts, 100_000)
    n, found = df.select(keys.alias("h")).agg(F.count("*"), F.expr(f"approx_top_k(h, {most}, {10 * most})")).first()
    return [x.item for x in found or () if x["count"] * 4 * parts > n]


def split_join(left: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """left join table, whose keys are unique, in two: rows of hot keys find theirs in memory, where they lie, and only the rest is shuffled.

    So a word that a third of all rows hold is no task of its own. left is stored, as it is read three times. how: left, inner, left_semi or left_anti.
    """
    left = left if hasattr(left, "stored_at") else stored(left, "split-join")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here, there = _hash_of(left, table, keys), _hash_of(table, left, keys)
    hot = hot_hashes(left, here, parts)
    if not hot:
        return left.join(table, keys, how)
    few = stored(table.where(there.isin(hot)), "hot-keys")
    # as many rows as there are hot keys, unless keys repeat
    few = F.broadcast(few) if stored_bytes(few) <= BROADCAST_BYTES else few
    return left.where(here.isin(hot)).join(few, keys, how).unionByName(left.where(~here.isin(hot)).join(table.where(~there.isin(hot)), keys, how))


def spread(df: DataFrame, key: str) -> DataFrame:
    """df dealt by key if its scan has fewer partitions than the cluster has cores: files of one row group can't be split."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, key) if df.rdd.getNumPartitions() < n else df


def numbered(df: DataFrame, group: list[str], order: list[Column | str], name: str) -> DataFrame:
    """df with `name`, the row's place from 0 in its group by `order`, which must tell rows apart.

    Rows are dealt by ranges and sorted, so a group may span many tasks; where each task begins in each of its groups is
    a running sum over a row for each group and task. No group passes one task whole. df is stored first, as dealing by ranges reads it twice.
    """
    df = df if hasattr(df, "stored_at") else stored(df, "to-number")
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = stored(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    keys = [F.col(c) for c in group]
    parts = placed.groupBy(*keys, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    renamed = parts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), "_from", "_before")
    same = [placed[c].eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)] + [placed["_part"] == F.col("_p")]
    return placed.join(renamed, same).withColumn(name, (F.col("_at") - F.col("_from") + F.col("_before")).cast("long")).select(*df.columns, name)


def file_system(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, its class of paths)."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def listed_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    fs, Path = file_system(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(Path(folder))) if fs.exists(Path(folder)) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, Path = file_system(spark, path)
    source = fs.open(Path(path))
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a small file in place as a whole, by a rename. False if there is one already: of two that try, one wins."""
    fs, Path = file_system(spark, path)
    if fs.exists(Path(path)):
        return False
    waiting = Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(waiting)
    out.write(bytearray(text.encode()))
    out.close()
    placed = fs.rename(waiting, Path(path))
    if not placed:
        fs.delete(waiting, False)
    return placed


def remove(spark: SparkSession, path: str) -> None:
    fs, Path = file_system(spark, path)
    fs.delete(Path(path), True)
