"""Token ids in files: documents compressed one by one with a shared zstandard dictionary.

A folder holds three tables. ``dictionary``: the dictionary and its SHA-256. ``blocks``: documents
in ascending id order, in blocks of about BLOCK_BYTES; a block row has the frames of its
documents end to end, the offset of each (the index by which a short document is read alone), the
ids' number format, the hash of the dictionary, and where the block's ids start in its shard. A
shard is what one task wrote; shards follow one another in id order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.bpe import batches, encoder
from lectern.llm.common import new_path

BLOCK_BYTES = 256 * 1024
LEVEL = 3
_BLOCK = "shard int, block int, base long, first_id long, last_id long, dictionary string, dtype string, ids array<long>, offsets array<long>, counts array<long>, frames binary"


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample_docs: int = 1000, sample_chars: int = 16_384, size: int = 32_768) -> bytes:
    """A dictionary from the ids of ``sample_docs`` documents of up to ``sample_chars`` characters,
    chosen by hash. It bears on the compression alone; where there's too little to train on it is empty."""
    short = docs.filter(F.char_length("text") <= sample_chars).select(F.xxhash64("text").alias("h"), "text")
    chosen = [r["h"] for r in short.select("h").distinct().orderBy("h").limit(sample_docs).collect()]
    own = encoder(tokenizer)
    texts = [r["text"] for r in short.filter(F.col("h").isin(chosen)).groupBy("h").agg(F.first("text").alias("text")).orderBy("h").collect()] if chosen else []
    serial = [ids + np.array([end_id], own.dtype).tobytes() for s in batches(texts) for ids in own.by_pieces(texts[s])]
    try:
        return zstandard.train_dictionary(size, serial).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b""


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 0, sample_docs: int = 1000, id: str = "doc_id", text: str = "text") -> str:
    """Encodes whole texts, appends ``end_id`` to each, and writes them in ascending order of id
    (long; null first, equal ids by text). Returns the folder.

    Null and empty texts have the end id alone; equal rows are written each, and an empty table gives a folder without
    blocks' rows. Extra columns are left out, whatever their names. The texts move
    once, to be put in order; they are encoded where they are written. Equal ids stay in one shard.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    plain = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    dictionary = train_dictionary(plain, tokenizer, end_id, sample_docs)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, dictionary)], "hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(tokenizer)
        end = np.array([end_id], own.dtype).tobytes()
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
        shard, block, base = TaskContext.get().partitionId(), 0, 0
        ids, counts, packed, held = [], [], [], 0

        def flush() -> pd.DataFrame:
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in packed], dtype=np.int64)))
            row = (shard, block, base, ids[0], ids[-1], name, own.dtype.str, list(ids), offsets, list(counts), b"".join(packed))
            return pd.DataFrame([row], columns=[x.split()[0] for x in _BLOCK.split(", ")]).astype({"first_id": object, "last_id": object})

        for f in frames:
            texts = f["text"].tolist()
            keys = [None if not there else int(k) for k, there in zip(f["key"].tolist(), f["there"].tolist(), strict=True)]
            for s in batches(texts):
                for k, x in zip(keys[s], own.by_pieces(texts[s]), strict=True):
                    ids.append(k)
                    counts.append(len(x) // own.dtype.itemsize + 1)
                    packed.append(press.compress(x + end))
                    held += len(packed[-1])
                    if held >= BLOCK_BYTES:
                        yield flush()
                        block, base, held = block + 1, base + sum(counts), 0
                        ids, counts, packed = [], [], []
        if ids:
            yield flush()

    ordered = plain.repartitionByRange("id").sortWithinPartitions("id", "text")
    keyed = ordered.select(F.coalesce("id", F.lit(0)).alias("key"), F.col("id").isNotNull().alias("there"), "text")
    keyed.mapInPandas(write, _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def dictionary_of(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").head()
    held = bytes(row["dictionary"])
    if hashlib.sha256(held).hexdigest() != row["hash"]:
        raise ValueError(f"{path}: the dictionary doesn't have the hash it is kept under")
    return row["hash"], held


def _unpacker(name: str, dictionary: bytes):
    unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def unpack(row, i: int) -> np.ndarray:
        if row.dictionary != name:
            raise ValueError(f"block {row.shard}/{row.block} was written with dictionary {row.dictionary}, not {name}")
        return np.frombuffer(unpress.decompress(row.frames[row.offsets[i] : row.offsets[i + 1]]), np.dtype(row.dtype)).astype("<u4")

    return unpack


def starts(blocks: DataFrame) -> DataFrame:
    """(shard, start): the number of ids in all shards before; one row for each task that wrote."""
    sums = blocks.select("shard", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    return sums.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("start"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` ids) of each document in the files, null and repeated ids as they
    were written; nothing of a folder that was written from an empty table."""
    unpack_with = dictionary_of(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = _unpacker(*unpack_with)
        for f in frames:
            for row in f.itertuples(index=False):
                at = row.start + row.base + np.concatenate(([0], np.cumsum(row.counts)))
                found = [unpack(row, i) for i in range(len(row.counts))]
                out = {"doc_id": pd.array(list(row.ids), dtype=object), "start": at[:-1], "n_tokens": [len(x) for x in found], "ids_crc32": [zlib.crc32(x.tobytes()) for x in found]}
                if with_ids:
                    out["ids"] = [x.astype(np.int64) for x in found]
                yield pd.DataFrame(out)

    both = blocks.join(F.broadcast(starts(blocks)), "shard").withColumn("ids", F.transform("ids", lambda x: x.cast("string")))
    own = both.mapInPandas(read, "doc_id string, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return own.withColumn("doc_id", F.col("doc_id").cast("long"))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """One document's ids, of several with this id the first one's; None where there is none. The blocks' id ranges leave one
    block to read, and the offset index one frame."""
    unpack = _unpacker(*dictionary_of(spark, path))
    near = spark.read.parquet(f"{path}/blocks").filter((F.col("first_id").isNull() | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id))
    for row in near.collect():
        if doc_id in row["ids"]:
            return unpack(row, row["ids"].index(doc_id)).tolist()
    return None
