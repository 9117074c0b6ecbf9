"""Tables that a job writes for itself, and targets that readers find whole at any moment."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the session's
    checkpoint folder, else, with a local master alone, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lectern-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a reader of it. What follows starts from a table that
    lost executors don't touch, and joins with it can be split where a key is hot."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Files:
    """The few calls on a file system that a target needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        place = self.path_of(path)
        return [s.getPath().getName() for s in self.fs.listStatus(place)] if self.fs.exists(place) else []

    def touch(self, path: str) -> None:
        """Makes an empty file, in one step; an error if it is there."""
        self.fs.create(self.path_of(path), False).close()

    def remove(self, path: str) -> None:
        self.fs.delete(self.path_of(path), True)


def versions(spark: SparkSession, target: str) -> list[str]:
    """The committed versions of a target, oldest first."""
    return sorted(n for n in Files(spark, target).names(f"{target}/{COMMITS}") if re.fullmatch(r"\d{20}-[0-9a-f]{32}", n))


def commit(df: DataFrame, target: str, format: str = "json", keep: int = 2) -> str:
    """Writes ``df`` as a new version of ``target`` and makes it the current one.

    A version is a folder of its own, written in full before the commit record: an empty file whose name is that of
    the version, made in one step. Readers take the last record, so they find the old rows until that step and the
    new ones from then on, and a run that dies between any two steps leaves what was there. Of several writers at
    once the last name wins, each version being whole. The ``keep`` last versions stay for readers on their way;
    of older ones the record goes before the folder.
    """
    spark = df.sparkSession
    files, before = Files(spark, target), versions(spark, target)
    name = f"{int(before[-1][:20]) + 1 if before else 0:020d}-{uuid.uuid4().hex}"
    try:
        df.write.format(format).save(f"{target}/{name}")
        files.touch(f"{target}/{COMMITS}/{name}")
    except BaseException:
        if name not in versions(spark, target):
            files.remove(f"{target}/{name}")
        raise
    for old in [*before, name][:-keep]:
        files.remove(f"{target}/{COMMITS}/{old}")
        files.remove(f"{target}/{old}")
    return name


def current(spark: SparkSession, target: str, schema: str, format: str = "json") -> DataFrame:
    """The rows of the current version; none where nothing was ever committed."""
    found = versions(spark, target)
    return spark.read.schema(schema).format(format).load(f"{target}/{found[-1]}") if found else spark.createDataFrame([], schema)


_BUCKETS = "bucket int, folder string"


def held_rows(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """What ``write_changed`` keeps in a target: (path, content, sha256, bucket) as ``schema`` has them."""
    folders = current(spark, f"{target}/manifest", _BUCKETS).collect()  # a row for each bucket
    found = None
    for folder in sorted({r["folder"] for r in folders}):
        own = [r["bucket"] for r in folders if r["folder"] == folder]
        rows = spark.read.schema(schema).parquet(f"{target}/{folder}").filter(F.col("bucket").isin(own))
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


HELD = "path string, content string, sha256 string, bucket int"


def write_changed(rows: DataFrame, target: str, buckets: int = 64) -> DataFrame:
    """Brings ``target`` to ``rows`` (path, content; a path once) by writing those hash buckets alone in which
    something is new, other or gone, and returns (path, change) of these: new, changed or removed.

    Buckets that change are written to a folder of this run; then a manifest that names each bucket's folder is committed. So a
    run that dies leaves the rows of the one before, and the next one does its work again; what no manifest names is never
    read. Without changes nothing is written. Hashes alone are compared: contents are read where a bucket is written.
    """
    spark = rows.sparkSession
    now = rows.select("path", "content", F.sha2("content", 256).alias("sha256"), F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int").alias("bucket"))
    held = held_rows(spark, target, HELD).select("path", F.col("sha256").alias("was"), F.lit(True).alias("held"))
    both = now.select("path", "sha256", F.lit(True).alias("here")).join(held, "path", "full")
    kind = F.when(F.col("held").isNull(), "new").when(F.col("here").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("sha256")), "changed")
    changes = written(both.select("path", kind.alias("change")).filter("change is not null"), "changes")
    touched = sorted(r["b"] for r in changes.select(F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int").alias("b")).distinct().collect())  # buckets, not rows
    if touched:
        folder = f"rows-{uuid.uuid4().hex}"
        now.filter(F.col("bucket").isin(touched)).repartition("bucket").write.partitionBy("bucket").parquet(f"{target}/{folder}")
        kept = [(r["bucket"], r["folder"]) for r in current(spark, f"{target}/manifest", _BUCKETS).collect() if r["bucket"] not in touched]
        commit(spark.createDataFrame(kept + [(b, folder) for b in touched], _BUCKETS).coalesce(1), f"{target}/manifest")
    return changes


def sweep(spark: SparkSession, target: str) -> list[str]:
    """Removes the row folders of a ``write_changed`` target that no manifest still kept names, and returns them. Not for a time at
    which something is being written to it: what a run has begun isn't named yet."""
    named = {r["folder"] for v in versions(spark, f"{target}/manifest") for r in spark.read.schema(_BUCKETS).json(f"{target}/manifest/{v}").select("folder").distinct().collect()}
    files = Files(spark, target)
    gone = [n for n in files.names(target) if n.startswith("rows-") and n not in named]
    for n in gone:
        files.remove(f"{target}/{n}")
    return gone
