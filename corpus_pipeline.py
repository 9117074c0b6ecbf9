"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, and BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written to the
shared folder and read again as the next one's docs. All stages but the last return the columns of
``documents``, with texts as they are by then and ``n_chars`` to match.

What holds for all of them: columns may hold nulls anywhere, and a null text is an empty one; equal rows are taken
alike; columns beyond those of ``documents`` are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.bpe import digests, encode_documents
from lectern.llm.common import new_path
from lectern.llm.line_dedup import dedup_lines
from lectern.llm.mixing import mixed
from lectern.llm.near_copies import one_of_each_similar
from lectern.llm.quality import quality_filter
from lectern.llm.queries import table, tokenizer_path
from lectern.session import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay as they are. Null and empty texts have no words, so they
    go; equal rows stay or go together, and count as one document of their host."""
    ship(spark)
    return quality_filter(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; documents stay, even if no line of theirs does. A null text becomes an
    empty one; equal rows are documents each."""
    ship(spark)
    done = dedup_lines(docs.select(*COLUMNS))
    changed = F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return done.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", changed.alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id: texts with a
    five-word shingle Jaccard of 0.8 or more, and chains of them. Texts without words are copies of one another; of equal
    rows one stays. Candidates are op6's SimHash links and MinHash bands'; exact sets decide."""
    ship(spark)
    return one_of_each_similar(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them: not at all, once or twice. Null and empty texts are never taken; a
    null source is one of its own, the last."""
    ship(spark)
    return mixed(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of ids, and the digests of its ids and of the text they decode to; null and empty texts have
    no ids."""
    ship(spark)
    return encode_documents(docs.select(*COLUMNS), tokenizer_path("word_bpe_49k.json"), digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("near dedup", near_dedup), ("source mix", source_mix), ("bpe", encode)]

#: SQL can express neither shingle sets nor BPE. tests/llm holds run() to a plain version: rows of the first three stages and of BPE one by one,
#: the mix by its sources' targets.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over all that the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
