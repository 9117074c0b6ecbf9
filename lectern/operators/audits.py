"""Checks over a whole corpus, each a query that returns its offenders or counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def uneven_presence(df: DataFrame, keys: list[str], present: str) -> DataFrame:
    """Groups in which something is there for some rows and not for others."""
    out = df.groupBy(*keys).agg(F.count_if(present).alias("n_present"), F.count_if(~F.col(present)).alias("n_absent"))
    return out.filter("n_present > 0 and n_absent > 0")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """A06."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def success_ranking(df: DataFrame, name: str, ok: str) -> DataFrame:
    """By rate, not volume; (name, n, rate)."""
    return df.groupBy(name).agg(F.count("*").alias("n"), F.avg(F.col(ok).cast("double")).alias("rate"))


def ranked(chain: DataFrame, outcomes: DataFrame, name: str = "name", ordinal: str = "ordinal", ok: str = "ok") -> DataFrame:
    """``chain`` (name, ordinal) with the rate of each name's outcomes, 0.5 where there are none, and its
    position: by falling rate, ties in order of ``ordinal``. A chain is a short list of choices."""
    rates = success_ranking(outcomes, name, ok).select(name, "rate")
    both = chain.join(rates, name, "left").withColumn("rate", F.coalesce("rate", F.lit(0.5)))
    return both.withColumn("position", F.row_number().over(Window.orderBy(F.desc("rate"), ordinal)))


def publishable(events: DataFrame, date: str) -> DataFrame:
    """The events, if some are dated; else an error, so that nothing is overwritten by an empty set."""
    verdict = events_valid(events, date).select("valid")
    refused = F.raise_error(F.lit("refused: no dated events")).cast("boolean")
    return events.crossJoin(F.broadcast(verdict.select(F.when(F.col("valid"), True).otherwise(refused).alias("_ok")))).filter("_ok").drop("_ok")  # one row


def usage_totals(messages: DataFrame, ordinal: str = "ordinal", *keys: str) -> DataFrame:
    """The last result record if there is one, else the sum of all; for each of ``keys``, as a log's file."""
    parts = ["input_tokens", "cache_creation_input_tokens", "cache_read_input_tokens", "output_tokens"]
    total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    last = F.max_by(F.when(F.col("type") == "result", total), F.when(F.col("type") == "result", F.col(ordinal)))
    return messages.groupBy(*keys).agg(F.coalesce(last, F.sum(total), F.lit(0)).cast("long").alias("total_tokens"))


def shadow_alert(df: DataFrame, count: str) -> DataFrame:
    """A11."""
    n = F.try_to_number(F.trim(F.col(count)), F.lit("999999999"))
    return df.withColumn("alert", F.when(n.isNull(), "unavailable").when(n > 0, "firing").otherwise("quiet"))


def events_valid(df: DataFrame, date: str) -> DataFrame:
    """Total and dated events, and whether the set may be published."""
    out = df.agg(F.count("*").alias("total"), F.count_if(F.coalesce(F.col(date), F.lit("")) != "").alias("dated"))
    return out.withColumn("valid", (F.col("total") > 0) & (F.col("dated") > 0))
