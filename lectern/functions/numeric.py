"""Column functions over numbers, dates and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fnv1a32(c: Column) -> Column:
    """32-bit FNV-1a over UTF-16 units; a character beyond the basic plane is two."""
    points = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), F.ascii)
    units = F.flatten(F.transform(points, lambda x: F.when(x < 0x10000, F.array(x)).otherwise(F.array(F.shiftright(x - 0x10000, 10) + 0xD800, (x - 0x10000).bitwiseAND(0x3FF) + 0xDC00))))
    return F.aggregate(units, F.lit(2166136261).cast("long"), lambda h, x: (h.bitwiseXOR(x.cast("long")) * 16777619).bitwiseAND(4294967295))


def fnv1a32_mod(c: Column, n: int) -> Column:
    """a bucket below ``n``."""
    return fnv1a32(c) % n


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """F47."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371 * F.asin(F.sqrt(a))


def freshness(age_hours: Column) -> Column:
    """from 1.3 down to 1 over 48 hours; a missing age counts as 48."""
    age = F.coalesce(F.when(F.isnan(age_hours), None).otherwise(age_hours), F.lit(48.0))
    return 1 + 0.3 * F.greatest(F.lit(0.0), 1 - age / 48)


def age_hours(published: Column, now: Column) -> Column:
    """missing or bad gives 48, the future 0."""
    hours = (F.unix_micros(now) - F.unix_micros(F.try_to_timestamp(published))) / 3.6e9
    return F.when(hours.isNull(), 48.0).otherwise(F.greatest(F.lit(0.0), hours))  # greatest skips nulls


def trend_score(n: Column) -> Column:
    """F50."""
    return F.when((n > 0) & ~F.isnan(n), F.least(F.lit(100.0), 25 * F.log10(n + 1))).otherwise(0.0)


def rounded(x: Column) -> Column:
    """Half goes up."""
    return F.floor(x + 0.5)


def minutes_since(then: Column, now: Column) -> Column:
    """missing or bad gives null, the future 0."""
    minutes = rounded((F.unix_micros(now) - F.unix_micros(F.try_to_timestamp(then))) / 6e7)
    return F.when(minutes.isNotNull(), F.greatest(F.lit(0), minutes))


def minutes_text(m: Column) -> Column:
    """F53."""
    return F.concat(F.greatest(F.lit(0), rounded(m)).cast("string"), F.lit(" min"))


def minutes_delta_text(d: Column) -> Column:
    n = rounded(F.abs(d))
    return F.when(n == 0, "±0 min").otherwise(F.concat(F.when(d > 0, "+").otherwise("−"), n.cast("string"), F.lit(" min")))


def clamped_quota(q: Column) -> Column:
    """60 to 95, 80 where there is no number."""
    return F.when(q.isNull() | F.isnan(q.cast("double")), 80).otherwise(F.least(F.lit(95), F.greatest(F.lit(60), F.floor(q)))).cast("int")


def slot(counter: Column, quota: Column) -> Column:
    """T01."""
    return F.when(F.pmod(F.greatest(counter, F.lit(0)), F.lit(100)) < quota, "proven").otherwise("discovery")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit_vector(v: Column) -> Column:
    """zero vectors stay."""
    norm = F.sqrt(dot(v, v))
    return F.when(norm == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(F.transform(v, lambda x: x / norm))


def discovery_score(source: Column, imp: Column, window_days: Column, p50: Column, age: Column, trend: Column, anchored: Column) -> Column:
    """rawScore, confidence, freshness, finalScore and, for rows that can't be scored, score_error."""
    p = F.coalesce(F.when(F.isnan(p50), None).otherwise(p50), F.lit(100.0))
    by = lambda o, s, n, t: F.when(source == "orphan", o).when(source == "suggest", s).when(source == "news", n).when(source == "trends", t)
    raw = by(F.coalesce(imp, F.lit(0.0)) / F.coalesce(window_days, F.lit(90)) * p / 400, p * 0.5, p, F.greatest(F.coalesce(trend, F.lit(0.0)), 0.4 * p))
    confidence, fresh = by(1.0, 0.6, 0.7, 0.8), by(F.lit(1.0), F.lit(1.0), freshness(age), F.lit(1.15))
    error = F.when(~source.isin("orphan", "suggest", "news", "trends") | source.isNull(), "unknown source").when(source.isin("suggest", "trends") & ~F.coalesce(anchored, F.lit(False)), "no domain anchor")
    ok = error.isNull()
    return F.struct(F.when(ok, raw).alias("rawScore"), F.when(ok, confidence).alias("confidence"), F.when(ok, fresh).alias("freshness"), F.when(ok, raw * confidence * fresh).alias("finalScore"), error.alias("score_error"))
