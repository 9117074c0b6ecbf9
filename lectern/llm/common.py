"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the session's
    checkpoint folder, else, with a local master alone, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="lectern-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a reader of it: lineage ends in a table that
    survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def row_keys(*columns: str) -> list[Column]:
    """Two 64-bit hashes that name a row by its content, so that a row keeps its key in each scan,
    with ids that are null or repeat too. Equal rows share a key and get equal results."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in columns]
    return [F.xxhash64(*own).alias("_k1"), F.xxhash64(F.lit(7), *own).alias("_k2")]


def hash_pair(c: Column) -> tuple[Column, Column]:
    """128 bits of hash as two longs."""
    return F.xxhash64(c), F.xxhash64(F.lit(7), c)


def replacing(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, which an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def set_aside(df: DataFrame, *skip: str, **named: str) -> tuple[list[Column], list[Column]]:
    """The columns of ``df`` but ``skip`` under the names c0, c1, ..., which no working column has (or under
    the working name that ``named`` gives, as in t="text"), and the columns that give them their
    names back. An operator works between the two, so a caller's columns may have any name."""
    own, known = [c for c in df.columns if c not in skip], {v: k for k, v in named.items()}
    inner = [known.get(c, f"c{i}") for i, c in enumerate(own)]
    return [F.col(f"`{c}`").alias(n) for c, n in zip(own, inner, strict=True)], [F.col(n).alias(c) for c, n in zip(own, inner, strict=True)]
