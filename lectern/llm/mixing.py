"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import WORD, materialise, replacing, row_keys, set_aside


def water_fill(total: float, weights: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """Shares ``total`` by weight; what exceeds a cap goes to the others by weight until none does."""
    out, open_ = np.zeros(len(caps)), np.ones(len(caps), bool)
    left = min(float(total), float(caps.sum()))
    while open_.any() and left > 0:
        share = left * weights / weights[open_].sum()
        over = open_ & (share > caps)
        if not over.any():
            out[open_] = share[open_]
            break
        out[over] = caps[over]
        left -= float(caps[over].sum())
        open_ &= ~over
    return out


def sainte_lague(seats: int, votes: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """Gives ``seats`` to the highest quotients votes / (2 s + 1), s being the seats already held,
    with no more than ``caps`` for each; ties go to the earlier entry.

    Rounding votes / d is the same allocation for the number of seats that divisor d yields, so a
    divisor found by bisection leaves no more than a few seats a claimant to give one by one."""
    votes, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    caps = np.where(votes > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)
    at = lambda d: np.minimum(np.floor(np.minimum(votes / d + 0.5, 2.0**62)).astype(np.int64), caps)
    low, high = votes[votes > 0].min() / (2.0 * caps.max() + 4), 2.0 * votes.max() + 1  # at low all are full, at high none has a seat
    for _ in range(200):
        mid = (low + high) / 2
        if at(mid).sum() > seats:
            low = mid
        else:
            high = mid
    got = at(high)  # no more than the seats; what is missing ties at the last quotient
    while (left := int(seats - got.sum())) > 0:
        quotient = np.where(got < caps, votes / (2 * got + 1), -1.0)
        best = np.lexsort((np.arange(len(votes)), -quotient))[:left]
        got[best[quotient[best] >= 0]] += 1
    return got


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2, block_words: int = 16, docs_per_shard: int = 1024, seed: int = 42, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How many words the mix takes of each document.

    The size of a document is its number of words. Sources in code point order, null last, get
    ``weights`` in turn; ``share`` times all words is shared by weight, no source above
    ``max_repeat`` times its own words, the excess going to the others. Each target is counted in
    blocks of ``block_words`` words: sources get blocks by highest Sainte-Lague quotients; a
    source's blocks go to its shards (a seeded deal of its documents, about ``docs_per_shard``
    each) in the same way; and in its shard, whose documents stand in seeded order, a quota is that
    many blocks in a row from a seeded start, round the end, after whole passes. Thus a source's
    words are within about a block for each of its shards of the target, no document is taken
    more than ``max_repeat`` times, and reruns agree.

    No step groups more than a shard's documents, or one row for each source or shard. Null texts
    have size 0 and take part with 0 words; null ids are dealt like any other; equal rows may differ
    in ``taken``. With no words at all, targets are 0; an empty table gives an empty one. Returns the columns of ``docs`` without the
    text (names below are replaced) and ``size``, ``source_size``, ``target``, ``taken``.
    """
    base = replacing(docs, "size", "source_size", "target", "taken")
    rest = [c for c in base.columns if c not in (id, text, source)]
    sized = materialise(
        docs.select(
            F.col(f"`{id}`").alias("_id"), F.col(f"`{source}`").alias("_source"), F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")]).alias("_rest"),
            F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
            F.xxhash64(F.lit(seed), F.col(f"`{id}`"), F.col(f"`{text}`")).alias("_order"),
        ),
        "mix-sizes",
    )

    def allot(pdf: pd.DataFrame) -> pd.DataFrame:
        """One row for each source: its target and its blocks."""
        pdf = pdf.assign(_null=pdf["_source"].isna()).sort_values(["_null", "_source"], kind="stable").reset_index(drop=True)
        size = pdf["_words"].to_numpy(np.float64)
        target = water_fill(share * size.sum(), np.array([weights[i % len(weights)] for i in range(len(pdf))], float), max_repeat * size)
        blocks = sainte_lague(int(np.floor(target.sum() / block_words + 0.5)), target, max_repeat * (-(-pdf["_words"].to_numpy(np.int64) // block_words) + pdf["_shards"].to_numpy(np.int64)))
        return pdf.drop(columns="_null").assign(_target=target, _blocks=blocks)

    kind = sized.schema["_source"].dataType.simpleString()
    per_source = sized.groupBy("_source").agg(F.sum("_size").alias("_words"), F.greatest(F.lit(1), F.ceil(F.count("*") / docs_per_shard)).cast("long").alias("_shards"))
    per_source = materialise(per_source.groupBy().applyInPandas(allot, f"_source {kind}, _words long, _shards long, _target double, _blocks long"), "mix-sources")
    same_source = lambda a, b: a["_source"].eqNullSafe(b["_source"])
    dealt = sized.join(per_source, same_source(sized, per_source)).drop(per_source["_source"]).withColumn("_shard", F.pmod(F.col("_order"), F.col("_shards")))

    def allot_shards(pdf: pd.DataFrame) -> pd.DataFrame:
        """One row for each shard of a source."""
        pdf = pdf.sort_values("_shard").reset_index(drop=True)
        words = pdf["_in_shard"].to_numpy(np.int64)
        n = -(-words // block_words)
        return pdf.assign(_n=n, _quota=sainte_lague(int(pdf["_blocks"].iloc[0]), words.astype(float), max_repeat * n))[["_source", "_shard", "_n", "_quota"]]

    shards = dealt.groupBy("_source", "_shard").agg(F.sum("_size").alias("_in_shard"), F.first("_blocks").alias("_blocks"))
    shards = shards.groupBy("_source").applyInPandas(allot_shards, f"_source {kind}, _shard long, _n long, _quota long")
    placed = dealt.withColumn("_end", F.sum("_size").over(Window.partitionBy("_source", "_shard").orderBy("_order", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)))
    both = placed.join(shards, same_source(placed, shards) & (placed["_shard"] == shards["_shard"])).drop(shards["_source"], shards["_shard"])
    n, passes, rest_blocks = F.greatest(F.col("_n"), F.lit(1)), F.expr("_quota div greatest(_n, 1)"), F.expr("_quota % greatest(_n, 1)")
    start = F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), "_source", "_shard"), n)

    def overlap(first, last):
        return F.greatest(F.lit(0), F.least(F.col("_end"), last * block_words) - F.greatest(F.col("_end") - F.col("_size"), first * block_words))

    taken = passes * F.col("_size") + overlap(start, F.least(start + rest_blocks, n)) + overlap(F.lit(0), F.greatest(start + rest_blocks - n, F.lit(0)))
    return both.select(
        F.col("_id").alias(id), F.col("_source").alias(source), *[F.col("_rest").getField(c).alias(c) for c in rest],
        F.col("_size").alias("size"), F.col("_words").alias("source_size"), F.col("_target").alias("target"), taken.cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: each document as often as its words are taken, rounded, so that texts stay
    whole; a shard has two documents at most that its first and last block cut. Texts without words
    (null and empty ones too) are never taken; equal rows are taken alike, as often as the luckiest of
    them; ids may be null or repeat. An empty table gives an empty one; columns keep any name."""
    keyed = docs.select(*row_keys(id, text), F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").alias("source"))
    taken = mix(keyed, id="id", text="text", source="source", **options)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    times = taken.groupBy("_k1", "_k2").agg(F.max(times).alias("times")).filter("times > 0")
    inner, back = set_aside(docs)
    joined = docs.select(*inner, *row_keys(id, text)).join(times, ["_k1", "_k2"])
    return joined.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*back)
