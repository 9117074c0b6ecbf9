"""Candidates, logs and state tables of a corpus's upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.numeric import age_hours, clamped_quota
from lectern.functions.text import filename_words, html_to_text, publisher_host, trimmed
from lectern.operators.dedup import keep_first
from lectern.operators.publish import numbered

_USAGE = "input_tokens long, cache_creation_input_tokens long, cache_read_input_tokens long, output_tokens long"


def news_candidates(items: DataFrame, now: Column, ordinal: str = "ordinal") -> DataFrame:
    """One row for each headline whatever its case, the first by ``ordinal``; items are (ordinal,
    keyword, link, source_name, source_url, published, seed)."""
    rows = items.withColumn("headline", trimmed(F.coalesce("keyword", F.lit("")))).filter("headline <> ''")
    first = keep_first(rows, F.lower("headline"), [ordinal])
    return first.select("headline", F.col("link").alias("url"), F.lit("news").alias("source"), age_hours(F.col("published"), now).alias("ageHours"), F.col("source_name").alias("sourceName"), publisher_host(F.col("source_url")).alias("publisherHost"), F.col("published").alias("pubDate"), "seed")


def post_headlines(posts: DataFrame, now: Column, max_days: int = 7, least: int = 10) -> DataFrame:
    """Posts of any number of sites (host, title, link, date) with a headline of ``least``
    characters, a link and a date that parses and isn't older than ``max_days``."""
    at = F.try_to_timestamp("date")
    rows = posts.select(trimmed(F.coalesce("link", F.lit(""))).alias("url"), html_to_text(F.coalesce("title", F.lit(""))).alias("headline"), at.alias("date"), F.concat(F.lit("wp-search:"), "host").alias("source"))
    recent = F.unix_micros(now) - F.unix_micros("date") <= max_days * 86_400_000_000
    return rows.filter((F.char_length("headline") >= least) & (F.col("url") != "") & recent)


def log_messages(files: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """(ordinal, type and token counts) of logs held whole in ``column``: an array, an object with
    ``messages``, one object, or an object a line, of which bad ones are skipped. For logs of lines see
    ``logged_messages``, which holds none of them whole. Columns named in ``keep`` stay."""
    text = trimmed(F.col(column))
    listed = F.from_json(text, f"array<struct<{_ddl()}>>")
    inner = F.from_json(text, f"struct<messages:array<struct<{_ddl()}>>>")["messages"]
    lines = F.transform(F.filter(F.split(text, "\n"), lambda x: trimmed(x) != ""), lambda x: F.from_json(x, f"struct<{_ddl()},_bad:string>", {"columnNameOfCorruptRecord": "_bad"}))
    good = F.transform(F.filter(lines, lambda m: m["_bad"].isNull()), lambda m: F.struct(m["type"].alias("type"), m["usage"].alias("usage"), m["message"].alias("message")))
    one = F.array(F.from_json(text, f"struct<{_ddl()}>"))
    heads = F.split(text, "\n", 2)
    many = (F.size(heads) > 1) & F.try_parse_json(F.get(heads, 0)).isNotNull()  # the first line is whole by itself
    whole = F.startswith(text, F.lit("{")) & F.try_parse_json(text).isNotNull() & ~many
    found = F.when(F.startswith(text, F.lit("[")), listed).when(whole & inner.isNotNull(), inner).when(whole, one).otherwise(good)
    return files.select(*keep, F.posexplode(found).alias("ordinal", "m")).select(*keep, "ordinal", "m.type", *_used())


def _used() -> list[Column]:
    names = [c.split()[0] for c in _USAGE.split(", ")]
    return [F.coalesce(F.col(f"m.message.usage.{c}"), F.col(f"m.usage.{c}")).alias(c) for c in names]


def logged_messages(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, type and token counts) of the logs in a folder, of any number and size. Logs of an object a line
    are read line by line, a long one by several tasks; their order is that of the places in the file. What begins as
    an array, or as an object that its first line doesn't end, is JSON as a whole and is read so, file by file.
    Lines that don't parse are skipped."""
    at = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("file"), at.alias("ordinal"), trimmed(F.col("value")).alias("value")).filter("value <> ''")
    firsts = lines.groupBy("file").agg(F.min_by("value", "ordinal").alias("first"), F.count("*").alias("n"))
    ends = F.try_parse_json("first").isNotNull()
    whole = firsts.filter(F.startswith("first", F.lit("[")) | (F.startswith("first", F.lit("{")) & (~ends | (F.col("n") == 1)))).select("file")
    parsed = lines.join(whole, "file", "left_anti").select("file", "ordinal", F.from_json("value", f"struct<{_ddl()},_bad:string>", {"columnNameOfCorruptRecord": "_bad"}).alias("m"))
    single = parsed.filter("m._bad is null").select("file", "ordinal", "m.type", *_used())
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value").join(whole, "file", "left_semi")
    listed = log_messages(files, keep=("file",)).withColumn("ordinal", F.struct(F.lit(0).cast("long").alias("start"), F.col("ordinal").cast("long").alias("at")))
    return single.unionByName(listed)


def _ddl() -> str:
    usage = _USAGE.replace(" long", ":bigint").replace(", ", ",")
    return f"type:string,usage:struct<{usage}>,message:struct<usage:struct<{usage}>>"


def quota_states(raw: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """States of a quota from JSON; whatever is absent or bad has its default. Columns named in ``keep`` stay."""
    s = F.from_json(column, "version int, runCounter long, currentQuota double, lastTune string")
    rows = raw.select(s.alias("s"), *keep)
    return rows.select(*keep, F.coalesce("s.version", F.lit(1)).alias("version"), F.greatest(F.coalesce("s.runCounter", F.lit(0)), F.lit(0)).alias("runCounter"), clamped_quota(F.col("s.currentQuota")).alias("currentQuota"), "s.lastTune")


def counted(states: DataFrame, succeeded: bool = True) -> DataFrame:
    """States with the counter one up, after a success only; ``publish.replace_json`` saves them."""
    return states.withColumn("runCounter", F.col("runCounter") + int(succeeded))


def cluster_seeds(clusters: DataFrame, templates: DataFrame, most: int = 8) -> DataFrame:
    """(position, seed): the seeds of clusters by falling p50, each once, at most ``most``. Ties keep
    the order of ``ordinal``; clusters (ordinal, cluster, p50), templates (cluster, place, seed)."""
    rows = clusters.filter((F.col("cluster") != "generic") & F.col("p50").isNotNull() & ~F.isnan(F.col("p50").cast("double"))).join(templates, "cluster")
    rows = rows.select("seed", F.struct((-F.col("p50")).alias("p"), "ordinal", "place").alias("o"))
    top = rows.groupBy("seed").agg(F.min("o").alias("o")).orderBy("o").limit(most)
    return top.select(F.row_number().over(Window.orderBy("o")).alias("position"), "seed")


def catalog_entries(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """(path, words) of webp files with words in their names that the catalog lacks."""
    rows = files.filter(F.endswith(F.lower("path"), F.lit(".webp"))).select("path", filename_words(F.col("path")).alias("words"))
    return rows.filter(F.size("words") > 0).join(catalog.select("path").distinct(), "path", "left_anti")


def append_entries(entries: DataFrame, path: str) -> None:
    """Appends (path, words) to the catalog table at ``path``."""
    entries.select("path", "words").write.mode("append").parquet(path)


def manifest(files: DataFrame, commit: str, group: str = "kind") -> DataFrame:
    """By kind of file, how many there are and how many bytes they hold."""
    return files.groupBy(group).agg(F.count("*").alias("files"), F.sum(F.octet_length("content")).cast("long").alias("bytes")).withColumn("commit", F.lit(commit))


def repairs(dates: DataFrame, registered: DataFrame, article_id: Column) -> DataFrame:
    """``dates`` with (id, verdict) of editions to repair: bad date, not registered, or ok. ``registered`` (id)."""
    known = registered.select("id", F.lit(True).alias("_known")).distinct()
    rows = dates.withColumn("id", F.when(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$"), article_id)).join(known, "id", "left")
    return rows.withColumn("verdict", F.when(F.col("id").isNull(), "bad date").when(F.col("_known").isNull(), "not registered").otherwise("ok")).drop("_known")


def changed_descriptions(current: DataFrame, wanted: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(id, description): what a repair would write: descriptions other than the present one, of ids whose
    verdict is ok. A dry run shows these rows, a real one writes them and no others."""
    ok = verdicts.filter("verdict = 'ok'").select("id").distinct()
    both = wanted.select("id", F.col("description").alias("_new")).join(ok, "id", "left_semi").join(current.select("id", "description"), "id")
    return both.filter(~F.col("_new").eqNullSafe(F.col("description"))).select("id", F.col("_new").alias("description"))


def longest_runs(rows: DataFrame, key: str, order: str, failed: str, block: int = 1_000_000) -> DataFrame:
    """By key, the most failures in a row; a success ends a run. Rows are numbered by ``order`` and cut into blocks of
    ``block`` rows, each summed up by itself as the failures before its first success, after its last one and
    its longest run; a key's few sums are put together in order."""
    plain = rows.select(F.col(key).alias("key"), F.col(order).alias("by"), F.coalesce(F.col(failed), F.lit(False)).alias("failed"))
    each = numbered(plain, [F.col("by")], "at").withColumn("part", F.floor((F.col("at") - 1) / block))
    within = Window.partitionBy("key", "part").orderBy("at")
    run = each.withColumn("run", F.count_if(~F.col("failed")).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    runs = run.groupBy("key", "part", "run").agg(F.count_if("failed").alias("n"))
    sums = runs.groupBy("key", "part").agg(F.max("run").alias("ends"), F.sum(F.when(F.col("run") == 0, F.col("n"))).alias("lead"), F.max_by("n", "run").alias("trail"), F.max("n").alias("most"))
    parts = sums.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("part", "ends", F.coalesce("lead", F.lit(0)).alias("lead"), "trail", "most"))).alias("p"))
    zero = F.lit(0).cast("long")

    def step(acc, p):
        on = acc["run"] + p["lead"]  # a run that goes on from the part before
        return F.struct(F.greatest(acc["best"], on, p["most"]).alias("best"), F.when(p["ends"] == 0, on).otherwise(p["trail"]).alias("run"))

    return parts.select(F.col("key").alias(key), F.aggregate("p", F.struct(zero.alias("best"), zero.alias("run")), step, lambda acc: acc["best"]).alias("longest"))


def hub_slugs(sections: DataFrame) -> DataFrame:
    """(slug, section, locale) from (section, index_slugs map); join a slug with it for its section."""
    return sections.select("section", F.explode("index_slugs").alias("locale", "slug")).select("slug", "section", "locale")


def purge_requests(urls: DataFrame, origins: list[str]) -> DataFrame:
    """each URL as it is cached without an origin and for each of ``origins``."""
    variants = F.array(F.lit(None).cast("string"), *[F.lit(o) for o in origins])
    return urls.select("url", F.explode(variants).alias("origin"))


def stable_chunk(name: Column) -> Column:
    """the file of a chunk by its name."""
    return F.concat(name, F.lit(".js"))


def first_candidates(files: DataFrame, wanted: DataFrame, ordinal: str = "file") -> DataFrame:
    """For each wanted (name) the file name.js if it is there, else the first name-hash.js in order of
    ``ordinal``; null if there is neither. A hash has any length. Each file offers every name that it may be
    of, one for each dash, so both steps are joins by name."""
    rows = files.filter(F.endswith("file", F.lit(".js"))).select("file", F.col(ordinal).alias("_at"), F.expr("left(file, length(file) - 3)").alias("_stem"))
    steps = F.split("_stem", "-")
    cuts = F.sequence(F.lit(1), F.size(steps) - 1)
    named = F.transform(cuts, lambda i: F.struct(F.array_join(F.slice(steps, 1, i), "-").alias("name"), F.array_join(F.slice(steps, i + 1, F.size(steps)), "-").alias("hash")))
    hashed = rows.select("file", "_at", F.explode(F.when(F.size(steps) > 1, named)).alias("n")).filter(F.col("n.hash").rlike("^[A-Za-z0-9_-]+$"))
    offers = rows.select(F.col("_stem").alias("name"), "file", F.lit(0).alias("_rank"), "_at").unionByName(hashed.select("n.name", "file", F.lit(1).alias("_rank"), "_at"))
    asked = wanted.select("name").distinct()
    best = offers.join(asked, "name", "left_semi").groupBy("name").agg(F.min_by("file", F.struct("_rank", "_at")).alias("file"))
    return wanted.join(best, "name", "left")


def shadowed_articles(articles: DataFrame, overrides: DataFrame, slug: str = "slug") -> DataFrame:
    """The articles whose slug is that of an article which another address overrides; nothing is taken
    away from where they came from. Many overrides of one slug give no article twice."""
    return articles.join(overrides.select(F.col("slug").alias(slug)).distinct(), slug, "left_semi")
