"""From a registry of articles to a sitemap, feeds and manifests."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.text import xml_escaped
from lectern.storage import commit, current, written

LOCALES = ("it", "en", "de", "fr")


def sitemap_rows(registry: DataFrame, slugs: DataFrame, meta: DataFrame, shadowed: DataFrame, site: str, paths: dict[str, str]) -> DataFrame:
    """(id, slug, xml), an <url> element for each registered article with a slug in
    the first locale that isn't shadowed. ``slugs`` (id, locale, slug), ``meta`` (id, field, value),
    ``shadowed`` (slug); absent locales, images and dates are left out."""
    wide = slugs.groupBy("id").agg(*[F.max(F.when(F.col("locale") == x, F.nullif(F.col("slug"), F.lit("")))).alias(f"slug_{x}") for x in LOCALES])
    text = meta.groupBy("id").agg(*[F.max(F.when(F.col("field") == f, F.nullif(F.col("value"), F.lit("")))).alias(a) for f, a in (("title", "title"), ("imageAlt", "alt"))])
    rows = registry.join(wide, "id").filter(F.col("slug_it").isNotNull()).join(shadowed.select(F.col("slug").alias("slug_it")).distinct(), "slug_it", "left_anti").join(text, "id", "left")
    image = F.when(F.col("image") != "", F.when(F.startswith("image", F.lit("http")), F.col("image")).otherwise(F.concat(F.lit(site), F.col("image"))))
    date = F.nullif(F.coalesce(F.nullif(F.col("updatedAt"), F.lit("")), F.col("date")), F.lit(""))

    def element(before: str, value: Column, after: str) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(before), value, F.lit(after)))

    def alternate(name: str, path: str, slug: str) -> Column:
        return element(f'    <xhtml:link rel="alternate" hreflang="{name}" href="{site}{path}', F.when(F.col(slug).isNotNull(), xml_escaped(F.col(slug))), '/" />')

    shown = lambda c: F.when(image.isNotNull() & F.col(c).isNotNull(), xml_escaped(F.col(c)))
    xml = F.concat_ws(
        "\n", F.lit("  <url>"), element(f"    <loc>{site}{paths['it']}", xml_escaped(F.col("slug_it")), "/</loc>"),
        F.when(image.isNotNull(), "    <image:image>"), element("      <image:loc>", F.when(image.isNotNull(), xml_escaped(image)), "</image:loc>"),
        element("      <image:title>", shown("title"), "</image:title>"), element("      <image:caption>", shown("alt"), "</image:caption>"), F.when(image.isNotNull(), "    </image:image>"),
        *[alternate(x, paths[x], f"slug_{x}") for x in LOCALES], alternate("x-default", paths["it"], "slug_it"),
        element("    <lastmod>", date, "</lastmod>"), F.lit("    <changefreq>monthly</changefreq>"), F.lit("    <priority>0.7</priority>"), F.lit("  </url>"),
    )
    return rows.select("id", F.col("slug_it").alias("slug"), xml.alias("xml"))


def feed_items(articles: DataFrame, site: str, path: str) -> DataFrame:
    """An <item> for each article; its guid is the id, which isn't a link."""
    link = F.concat(F.lit(site + path), F.col("slug"), F.lit("/"))
    return articles.select("id", F.concat(F.lit("<item><title>"), xml_escaped(F.col("title")), F.lit("</title><link>"), xml_escaped(link), F.lit('</link><guid isPermaLink="false">'), xml_escaped(F.col("id").cast("string")), F.lit("</guid></item>")).alias("xml"))


def canonical_urls(articles: DataFrame, overrides: DataFrame, default: Column) -> DataFrame:
    """An override that is an URL wins; with the winner's slug."""
    good = overrides.filter(F.startswith("winner_url", F.lit("http"))).select("slug", "winner_url")
    last = F.element_at(F.split(F.regexp_replace("winner_url", "/$", ""), "/"), -1)
    return articles.join(good, "slug", "left").withColumns({"canonical": F.coalesce("winner_url", default), "winner_slug": last}).drop("winner_url")


def changed_files(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(path, sha256, change) of what is new or other than in the previous manifest."""
    now = current.select("path", F.sha2("content", 256).alias("sha256"))
    old = previous.select("path", F.col("sha256").alias("was"))
    return now.join(old, "path", "left").filter(~F.col("was").eqNullSafe(F.col("sha256"))).select("path", "sha256", F.when(F.col("was").isNull(), "new").otherwise("changed").alias("change"))


def shrink_guard(new: int, old: int) -> None:
    """K09."""
    if new * 2 < old:
        raise ValueError(f"refused: {new} rows where there were {old}")


def newest(df: DataFrame, date: str, id: str, n: int = 5) -> DataFrame:
    """O03; ties go to the smaller id."""
    return df.orderBy(F.desc(date), id).limit(n)


def numbered(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Rows numbered from 1 by the values of ``order``, ascending, nulls first; ties go by a hash of the row.

    Rows are put in order by ranges, as many as the session's shuffle has partitions, and written with their place
    in their range; a range begins where the counts of those before end. The hash is part of the ranges' bounds, so that a value
    that very many rows have is cut as well; equal rows alone stay together. One exchange; after it a row for each range."""
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]  # any name may be among the caller's
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.select(*own, *[c.alias(f"by{i}") for i, c in enumerate([*order, tie])])
    by = [f"by{i}" for i in range(len(order) + 1)]
    placed = keyed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id()).drop(*by)
    rows = written(placed, "numbered").withColumn("part", F.shiftrightunsigned("place", 33))
    counts = rows.groupBy("part").count()
    before = counts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    number = F.col("place").bitwiseAND((1 << 33) - 1) + F.col("before") + 1
    return rows.join(F.broadcast(before), "part").select(*back, number.alias(name))


def group_medians(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, p50), the exact median of each key's values, from their places in one order of all rows by key and
    value, so no group's values are held or sorted together. Null values don't count, keys that have no others are left
    out, and a null key is a key."""
    rows = df.select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")).filter("v is not null")
    placed = numbered(rows, [F.col("k"), F.col("v")], "at")
    ends = placed.groupBy("k").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    low, high = F.col("first") + F.floor((F.col("n") - 1) / 2), F.col("first") + F.floor(F.col("n") / 2)
    middle = ends.select(F.col("k").alias("of"), F.explode(F.array(low, high)).alias("at"))  # one row or two equal ones for each key
    return placed.join(middle, "at").groupBy(F.col("of").alias(key)).agg(F.avg("v").alias("p50"))


def preferred_order(df: DataFrame, preferred: list[str], name: str, ordinal: str) -> DataFrame:
    """(position): preferred names first, in that order, then the rest as they came."""
    at = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col(name)), F.lit(0))
    return numbered(df, [F.when(at > 0, at).otherwise(len(preferred) + 1), F.col(ordinal)])


#: The paths of a section's articles by locale.
SECTION_PATHS = {
    "frontaliere": {"it": "/articoli-frontaliere/", "en": "/en/cross-border-articles/", "de": "/de/grenzgaenger-artikel/", "fr": "/fr/articles-frontalier/"},
    "svizzera": {"it": "/articoli-svizzera/", "en": "/en/swiss-articles/", "de": "/de/schweiz-artikel/", "fr": "/fr/articles-suisse/"},
}
#: How a sitemap begins and ends.
URLSET = """<?xml version="1.0" encoding="UTF-8"?>
<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"
        xmlns:xhtml="http://www.w3.org/1999/xhtml"
        xmlns:image="http://www.google.com/schemas/sitemap-image/1.1">
"""


def sitemap_documents(rows: DataFrame, ordinal: str = "ordinal", per_file: int = 50_000) -> DataFrame:
    """(file, count, xml): whole sitemaps of ``rows`` (ordinal, xml) in order, ``per_file`` URLs each at
    most, the most that the protocol allows; so no file outgrows a task."""
    each = numbered(rows, [F.col(ordinal)])
    files = each.groupBy(F.expr(f"cast((position - 1) div {per_file} as int)").alias("file")).agg(F.count("*").alias("count"), F.sort_array(F.collect_list(F.struct("position", "xml"))).alias("urls"))
    return files.select("file", "count", F.concat(F.lit(URLSET), F.array_join("urls.xml", "\n"), F.lit("\n</urlset>\n")).alias("xml"))


def feed_document(items: DataFrame, title: str, link: str, description: str, language: str, date: str, id: str, n: int = 50) -> DataFrame:
    """(xml): a channel with the ``n`` newest of ``items`` (xml and the columns ``date`` and ``id``)."""
    top = newest(items, date, id, n)
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.struct((-F.unix_date(F.col(date).cast("date"))).alias("d"), F.col(id).alias("i")).alias("o"), F.col("xml").alias("x")))), lambda s: s["x"]), "\n")
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel>'
    field = lambda name, value: F.concat(F.lit(f"<{name}>"), xml_escaped(F.lit(value)), F.lit(f"</{name}>"))
    return top.agg(F.concat(F.lit(head), field("title", title), field("link", link), field("description", description), field("language", language), F.lit("\n"), body, F.lit("\n</channel></rss>\n")).alias("xml"))


def replace_json(df: DataFrame, target: str) -> bool:
    """Commits ``df`` as the JSON rows of ``target``; ``storage.current`` reads them. At any moment a reader finds
    the old rows or the new ones; where something fails the old ones stay, what was begun is removed, and False is returned."""
    try:
        commit(df, target, "json")
        return True
    except (PySparkException, Py4JError):
        return False


def replace_guarded(df: DataFrame, target: str, schema: str) -> bool:
    """Commits ``df`` unless it has fewer than half the rows that ``target`` holds; False where it was refused."""
    rows = written(df, "guarded")
    try:
        shrink_guard(rows.count(), current(df.sparkSession, target, schema).count())
    except ValueError:
        return False
    return replace_json(rows, target)
