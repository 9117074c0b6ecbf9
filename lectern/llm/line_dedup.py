"""Line deduplication over the whole corpus, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import ASCII_SPACE, ascii_lower, hash_pair, materialise, replacing, row_keys, set_aside


def line_key(line: Column) -> Column:
    """The form in which lines are compared: ASCII white space off both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def lines_of(text: Column) -> Column:
    """The \\n-separated lines; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def frequent_lines(docs: DataFrame, min_docs: int, min_length: int, text: str = "text") -> DataFrame:
    """Hashes (h1, h2) of the line keys that at least ``min_docs`` rows hold. A row counts a key
    once, copies of a row count each; null and empty texts hold the empty key. Counts are summed in
    each map task before anything moves. An empty table gives an empty result."""
    keys = F.filter(F.transform(lines_of(F.col(f"`{text}`")), line_key), lambda k: F.char_length(k) >= min_length)
    hashed = F.array_distinct(F.transform(keys, lambda k: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(7), k).alias("h2"))))
    one = docs.select(F.explode(hashed).alias("h")).select("h.h1", "h.h2")
    return one.groupBy("h1", "h2").count().filter(F.col("count") >= min_docs).select("h1", "h2")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_length: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Drops every line whose key stands in ``min_docs`` documents or more.

    Lines are exploded with their positions, reduced to 128-bit hashes of their keys, and matched
    with the hashes of the frequent keys; the positions to drop are gathered for each document, and
    the document is put together again from the positions that stay. Just hashes and positions are
    exchanged for the counting; the texts move once, for the last join. The frequent keys are a table
    of their own: where it is small Spark sends it to every task by its size, else both sides of the
    join are plain exchanges, of which adaptive execution splits the one key that very many lines share.

    A row is a document: rows with null or repeated ids count by themselves. Null and empty texts
    are one empty line. Keys shorter than ``min_length`` code points are never dropped. Returns
    the columns of ``docs`` (those of the names below are replaced; any other name is kept), and
    ``n_lines``, ``n_dropped`` and ``kept_text``. An empty table gives an empty result.
    """
    frequent = materialise(frequent_lines(docs, min_docs, min_length, text), "line-frequent")
    lines = docs.select(*row_keys(id, text), F.posexplode(lines_of(F.col(f"`{text}`"))).alias("pos", "line"))
    key = line_key(F.col("line"))
    h1, h2 = hash_pair(F.col("key"))
    lines = lines.select("_k1", "_k2", "pos", key.alias("key")).filter(F.char_length("key") >= min_length).select("_k1", "_k2", "pos", h1.alias("h1"), h2.alias("h2"))
    drops = lines.join(frequent, ["h1", "h2"]).groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("drops"))
    base = replacing(docs, "n_lines", "n_dropped", "kept_text")
    inner, back = set_aside(base, t=text)
    joined = base.select(*inner, *row_keys(id, text)).join(drops, ["_k1", "_k2"], "left")
    own = lines_of(F.col("t"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.coalesce(F.col("t"), F.lit(""))).otherwise(F.array_join(F.transform(stay, lambda p: F.get(own, p)), "\n"))
    return joined.select(
        *back,
        F.size(own).cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )
