"""Registered queries over pages, files and logs that Spark writes from the driver's tables and reads back, and over
rules that the other modules show on few values."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern import storage
from lectern.functions import text as T
from lectern.operators import audits, dedup, publish, upkeep
from lectern.plans.queries import query, table
from lectern.sources import corpus
from lectern.storage import new_path

_CDN, _SITE = "https://cdn.example/images/blog/", "https://www.example.org"
#: What a page gets, by page_id % 8: as it stands, and what it becomes. # is the page's number.
_IMAGES = [
    ('<img src="/images/blog/a#.webp">', f'<img src="{_CDN}a#.webp">'),
    (f'<img src="{_SITE}/images/blog/b#.png?x=1">', f'<img src="{_CDN}b#.png?x=1">'),
    ('<img src="/images/blog/thumbnails/#.webp">', '<img src="/images/blog/thumbnails/#.webp">'),
    ('<img src="https://other.example/images/blog/c#.jpg">', '<img src="https://other.example/images/blog/c#.jpg">'),
    ('<a href="/images/blog/d#.pdf">', '<a href="/images/blog/d#.pdf">'),
    (f"see /images/blog/è#.avif, x@/images/blog/no.png {_CDN}e.jpeg", f"see {_CDN}è#.avif, x@/images/blog/no.png {_CDN}e.jpeg"),
    ("url(/images/blog/f g#.png) url('/images/blog/h#.png')", f"url(/images/blog/f g#.png) url('{_CDN}h#.png')"),
    ("https://raw.example/public/images/blog/i#.png.jpeg", "https://raw.example/public/images/blog/i#.png.jpeg"),
]


def _sql_pick(values, by: str, key: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"replace([{listed}][{by} % {len(values)} + 1], '#', {key}::varchar)"


def _pick(values, by, key):
    return F.replace(F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int")), F.lit("#"), key.cast("string"))


_FOLDED_NAMES = "with s as (select p_partkey id, list_distinct(list_transform(list_filter(regexp_extract_all(strip_accents(lower(p_name)), '[a-z0-9]+'), lambda x: len(x) >= 3), lambda x: x[1:6])) s from part)"


@query(f"""with p as (select page_id, coalesce(html, '') || {_sql_pick([a for a, _ in _IMAGES], 'page_id', 'page_id')} h from pages),
a as (select page_id, h, replace(h, '{_SITE}/images/blog/', chr(1)) x from p), b as (select page_id, h, regexp_replace(x, chr(1) || '([^"''\\s/?)]+?\\.(?:webp|png|jpe?g|avif))', '{_CDN}\\1', 'g') x from a),
c as (select page_id, h, replace(x, chr(1), '{_SITE}/images/blog/') x from b)
select page_id, sha256(regexp_replace(x, '(^|[^A-Za-z0-9_.@])/images/blog/([^"''\\s/?)]+?\\.(?:webp|png|jpe?g|avif))', '\\1{_CDN}\\2', 'g')) page, page_id % 8 in (0, 1, 5, 6) changed, true again from c""")
def cdn_pages(spark, d):
    """images of whole pages, and that a second time changes nothing."""
    html = F.concat(F.coalesce("html", F.lit("")), _pick([a for a, _ in _IMAGES], F.col("page_id"), F.col("page_id")))
    p = table(spark, d, "pages").select("page_id", html.alias("h")).withColumn("x", T.images_to_cdn(F.col("h"), "https://cdn.example", _SITE))
    return p.select("page_id", F.sha2("x", 256).alias("page"), (F.col("x") != F.col("h")).alias("changed"), (T.images_to_cdn(F.col("x"), "https://cdn.example", _SITE) == F.col("x")).alias("again"))


@query(f"""select page_id, {_sql_pick([b for _, b in _IMAGES], 'page_id', 'page_id')} done from pages""")
def cdn_fragments(spark, d):
    """what each kind of reference becomes."""
    return table(spark, d, "pages").select("page_id", T.images_to_cdn(_pick([a for a, _ in _IMAGES], F.col("page_id"), F.col("page_id")), "https://cdn.example", _SITE).alias("done"))


_VALUES = [
    ("/images/blog/a#.webp", f"{_CDN}a#.webp"), ("https://any.example/images/blog/b #.PNG", f"{_CDN}b #.PNG"), ("/images/blog/thumbnails/c#.webp", "/images/blog/thumbnails/c#.webp"), ("/images/blog/d#.pdf", "/images/blog/d#.pdf"),
    ("see /images/blog/e#.webp", "see /images/blog/e#.webp"), (f"{_CDN}f#.jpg", f"{_CDN}f#.jpg"), ("https://raw.example/public/images/blog/g#.jpg", "https://raw.example/public/images/blog/g#.jpg"), ("//x/images/blog/h#.avif", "//x/images/blog/h#.avif"),
]


@query(f"""select event_id, case when event_id % 9 = 8 then '' else {_sql_pick([b for _, b in _VALUES], '(event_id % 9)', 'event_id')} end as src from events""")
def cdn_values(spark, d):
    """whole values."""
    k = F.col("event_id")
    value = F.when(k % 9 < 8, _pick([a for a, _ in _VALUES], k % 9, k))
    return table(spark, d, "events").select("event_id", T.image_value_to_cdn(value, "https://cdn.example", ("https://raw.example/public/",)).alias("src"))


@query("""select (page_id // 50)::varchar section, 's' || page_id slug, 'https://w/' || page_id || case when (page_id // 50) % 3 = 1 then '/first/' else '/second/' end winner_url from pages where page_id % 4 <> 3 and (page_id // 50) % 6 <> 4""")
def section_overrides(spark, d):
    """Override files of many sections, written from pages: the first one doesn't parse in a third of them and
    isn't there in another; some parse and hold no overrides."""
    root, k, section = new_path(spark, "overrides"), F.col("page_id"), F.floor(F.col("page_id") / 50)
    entry = lambda last: F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("s"), k), F.when(k % 4 == 3, "not an address").otherwise(F.concat(F.lit("https://w/"), k, F.lit(last))))))
    pages = table(spark, d, "pages").groupBy(section.alias("section"))  # 50 pages at most
    first = pages.agg(entry("/first/").alias("o")).filter("section % 3 < 2")
    text = F.when(F.col("section") % 3 == 0, '{"overrides": {"s0": "https://w/bad/"}').when(F.col("section") % 6 == 4, F.to_json("o")).otherwise(F.to_json(F.struct(F.col("o").alias("overrides"))))
    first.select("section", text.alias("value")).write.partitionBy("section").text(f"{root}/data")
    pages.agg(entry("/second/").alias("o")).select("section", F.to_json(F.struct(F.lit(1).alias("version"), F.col("o").alias("overrides"))).alias("value")).write.partitionBy("section").text(f"{root}/content")
    return corpus.first_overrides(corpus.override_files(spark, root, ["missing", "data", "content"]))


@query("""select 'part-' || p_partkey as name, case p_partkey % 7 when 0 then 'part-' || p_partkey || '.js' when 1 then 'part-' || p_partkey || '-AB12.js' when 2 then 'part-' || p_partkey || '-Zz_-9999aaaa.js' when 4 then 'part-' || p_partkey || '-zzzz.js' when 6 then 'part-' || p_partkey || '-extra-view.js' end as file from part""")
def chunk_lookups(spark, d):
    """Names with dashes, hashes of any length, source maps, and the order of the listing."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select(k, F.concat(F.lit("part-"), k).alias("name"))
    kinds = [["-aaaa.js", ".js"], ["-AB12.js", "-AB12.js.map"], ["-Zz_-9999aaaa.js"], ["-AB12.js.map", ".js.map"], ["-zzzz.js", "-aaaa.js"], ["-.js", "-a.b.js"], ["-extra-view.js"]]
    listed = F.element_at(F.array(*[F.array(*[F.lit(x) for x in kind]) for kind in kinds]), (k % 7 + 1).cast("int"))
    files = p.select(F.posexplode(listed).alias("i", "end"), "name").select("i", F.concat("name", "end").alias("file"))
    return upkeep.first_candidates(files, p.select("name"), "i")


#: Closing references by case; # is the row's number, and the numbers that are found.
_CLOSING = [
    ("Chiude anche la issue #%, ferma con `x` e 6 prove a vuoto.", "[%]"), ("chiude #%", "[%]"), ("Risolve #%", "[%]"), ("Supera #%", "[%]"), ("Chiude il problema descritto ma non tocca #%", "[]"), ("Il problema racchiude molte cose #%", "[]"),
    ("Closes #%, #2 and #3", "[%,2,3]"), ("Fixes #% and touches #9", "[%]"), ("Closes #%\nfixes #2\nRESOLVED: #3\nSupersedes #4", "[%,2,3,4]"), ("Vedi #% per contesto", "[]"), ("prefixes #%", "[]"), ("Closed #% e #7 #8", "[%,7,8]"),
]


@query(f"""with c as (select conv_id, turn, conv_id * 100 + turn + 10 k, text from conversations) select conv_id, turn, replace([{', '.join("'" + b + "'" for _, b in _CLOSING)}][k % 12 + 1], '%', k::varchar) refs from c""")
def closing_declarations(spark, d):
    """the published cases, each after a whole turn's text."""
    k = F.col("conv_id") * 100 + F.col("turn") + 10
    said = F.replace(F.element_at(F.array(*[F.lit(a) for a, _ in _CLOSING]), (k % len(_CLOSING) + 1).cast("int")), F.lit("%"), k.cast("string"))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), said)
    refs = F.array_join(T.closing_references(text).cast("array<string>"), ",")
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("["), refs, F.lit("]")).alias("refs"))


@query("""with t as (select doc_id, coalesce(text, '') t from documents)
select doc_id, length(t) n, sha256(case when length(t) >= 99 then '😀' || left(t, 99) when length(t) = 98 then '😀' || t else '😀' || t || '😀' end) short, sha256('😀' || t || case when length(t) <= 99997 then '😀' else '' end) long_ from t where length(t) <= 99998
union all select doc_id, length(t), sha256('😀' || left(t, 99)), sha256('😀' || left(t, 99998)) from t where length(t) > 99998""")
def unit_cuts(spark, d):
    """whole texts between two characters of two units each, cut after 101 and after 100,000 units."""
    t = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("u", F.concat(F.lit("😀"), "t", F.lit("😀")))
    return t.select("doc_id", F.char_length("t").cast("long").alias("n"), F.sha2(T.truncated_units(F.col("u"), 101), 256).alias("short"), F.sha2(T.truncated_units(F.col("u"), 100_000), 256).alias("long_"))


@query("""with e as (select user_id % 40 log, event_id, event_id % 1000 n, event_type from events)
select log, case log % 4 when 1 then sum(n) else coalesce(arg_max(n, event_id) filter (event_type = 'error'), sum(n)) end::bigint total_tokens from e group by 1""")
def usage_by_log(spark, d):
    """Logs of forty kinds of users in files: lines, lines after a bad one, an array over several lines, and one
    object with messages. Errors stand in for results; every fourth log has none."""
    k, path = F.col("event_id"), new_path(spark, "logs")
    log = F.col("user_id") % 40
    e = table(spark, d, "events").select(log.alias("log"), "event_id", F.to_json(F.struct(F.when((F.col("event_type") == "error") & (log % 4 != 1), "result").otherwise("assistant").alias("type"), F.struct((k % 1000).alias("input_tokens")).alias("usage"))).alias("line"))
    e.filter("log % 4 < 2").select("log", "event_id", F.concat(F.when(k % 30 == 0, "not json\n").otherwise(""), "line").alias("value")).repartition("log").sortWithinPartitions("log", "event_id").select("log", "value").write.partitionBy("log").text(path)
    whole = e.filter("log % 4 > 1").groupBy("log").agg(F.sort_array(F.collect_list(F.struct("event_id", "line"))).alias("l"))  # JSON as a whole is a file's one value
    listed = F.concat(F.lit("[\n"), F.array_join("l.line", ",\n"), F.lit("\n]"))
    whole.select("log", F.when(F.col("log") % 4 == 2, listed).otherwise(F.concat(F.lit('{"messages": '), listed, F.lit("}"))).alias("value")).write.mode("append").partitionBy("log").text(path)
    found = upkeep.logged_messages(spark, path).withColumn("log", F.regexp_extract("file", r"log=(\d+)", 1).cast("long"))
    return audits.usage_totals(found, "ordinal", "log")


def _image(key: int) -> bytes:
    """A header of one of four formats, of a size that the key gives, and some bytes after it."""
    w, h, kind = key % 900 + 1, key % 700 + 2, key % 5
    if kind == 0:
        own = b"GIF89a" + w.to_bytes(2, "little") + h.to_bytes(2, "little")
    elif kind == 1:
        own = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + w.to_bytes(4, "big") + h.to_bytes(4, "big")
    elif kind == 2:
        own = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big") + b"\x03"
    elif kind == 3:
        own = b"RIFF\0\0\0\0WEBPVP8X\x0a\0\0\0\0\0\0\0" + (w - 1).to_bytes(3, "little") + (h - 1).to_bytes(3, "little")
    else:
        own = b"no image"
    return own + bytes(64 + key % 300_000)


@query("""select s_suppkey, case when s_suppkey % 5 < 4 then s_suppkey % 900 + 1 end::int width, case when s_suppkey % 5 < 4 then s_suppkey % 700 + 2 end::int height from supplier""")
def image_headers(spark, d):
    """A file for each supplier, written by tasks; of each the first bytes are read."""
    path = new_path(spark, "images")

    def write(frames):
        for f in frames:
            for key in f["s_suppkey"].tolist():
                system, inside = corpus.opened(f"{path}/{key % 7}/image {key}%20.bin")
                system.create_dir(inside.rpartition("/")[0])
                with system.open_output_stream(inside) as out:
                    out.write(_image(key))
            yield f

    table(spark, d, "supplier").select("s_suppkey").mapInPandas(write, "s_suppkey long").write.format("noop").mode("overwrite").save()
    return corpus.image_sizes(spark, path).select(F.regexp_extract("path", r"image (\d+)", 1).cast("long").alias("s_suppkey"), "width", "height")


@query("""select 'doc/' || doc_id path, sha256(case when doc_id % 5 = 1 then text || ' anew' else text end) sha256, case doc_id % 5 when 0 then 'new' when 1 then 'changed' end change from documents where doc_id % 5 <> 2""")
def incremental_sink(spark, d):
    """A target that lacks a fifth of the documents, has another fifth as it was and a third one that is gone; what
    it holds after the changed rows are written, and what became of each."""
    target, k = new_path(spark, "target"), F.col("doc_id")
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("doc/"), k).alias("path"), F.col("text").alias("content"))
    storage.write_changed(docs.filter(k % 5 != 0), target)
    changes = storage.write_changed(docs.filter(k % 5 != 2).withColumn("content", F.when(k % 5 == 1, F.concat("content", F.lit(" anew"))).otherwise(F.col("content"))), target)
    return storage.held_rows(spark, target, storage.HELD).select("path", "sha256").join(changes, "path", "left")


@query("""select c_custkey, round(c_acctbal, 2) + 1 bal from customer""")
def replaced_rows(spark, d):
    """Rows committed twice to one target; a third commit fails, and readers keep the second."""
    target = new_path(spark, "state")
    rows = table(spark, d, "customer").select("c_custkey", F.round("c_acctbal", 2).alias("bal"))
    publish.replace_json(rows, target)
    publish.replace_json(storage.current(spark, target, "c_custkey long, bal double").withColumn("bal", F.col("bal") + 1), target)
    publish.replace_json(rows.withColumn("bal", F.when(F.col("c_custkey") > 5, F.raise_error(F.lit("refused")).cast("double")).otherwise(0.0)), target)
    return storage.current(spark, target, "c_custkey long, bal double")


@query("""with a as (select doc_id, ['frontaliere', 'svizzera'][doc_id % 2 + 1] section, lang locale, 'd' || doc_id article_id, coalesce(text, '') || ' it''s `so` \\ ' || doc_id t from documents)
select section, locale, article_id, 'body' || f as field, sha256(case f when 1 then t else replace(t, '`', '') end) value from a, (values (1), (2)) v(f) union all
select section, locale, article_id, 'faq', sha256('[{"q":"Q' || doc_id || '?","a":"A \\"x\\""}]') from a where doc_id % 3 = 0""")
def article_files(spark, d):
    """An article file for each document, written by tasks, with values in quotes and in back-ticks, read back."""
    path = new_path(spark, "articles")

    def escaped(value: str, mark: str) -> str:
        value = value.replace("\\", "\\\\").replace(mark, "\\" + mark)
        return mark + (value.replace("\r", "\\r").replace("\n", "\\n") if mark == "'" else value) + mark

    def write(frames):
        made = {}  # a task opens and makes each folder once
        for f in frames:
            for key, lang, text in zip(f["doc_id"].tolist(), f["lang"].tolist(), f["text"].tolist(), strict=True):
                whole = f"{text or ''} it's `so` \\ {key}"
                fields = {"body1": escaped(whole, "'"), "body2": escaped(whole.replace("`", ""), "`")} | ({"faq": escaped(f'[{{"q":"Q{key}?","a":"A \\"x\\""}}]', "'")} if key % 3 == 0 else {})
                lines = "".join(f"  'blog.article.d{key}.{name}': {value},\n" for name, value in fields.items())
                folder = f"{path}/{('frontaliere', 'svizzera')[key % 2]}/{lang}"
                if folder not in made:
                    made[folder] = corpus.opened(folder)
                    made[folder][0].create_dir(made[folder][1])
                system, inside = made[folder][0], f"{made[folder][1]}/d{key}.ts"
                with system.open_output_stream(inside) as out:
                    out.write(f"export default {{\n{lines}}};\n".encode())
            yield f[["doc_id"]]

    table(spark, d, "documents").select("doc_id", "lang", "text").mapInPandas(write, "doc_id long").write.format("noop").mode("overwrite").save()
    return corpus.article_bodies(spark, path).select("section", "locale", "article_id", "field", F.sha2("value", 256).alias("value"))


@query("""select o_orderkey, o_orderstatus from orders""")
def guarded_rows(spark, d):
    """A set of fewer than half the rows is refused, and readers keep the rows of before."""
    target, schema = new_path(spark, "guarded"), "o_orderkey long, o_orderstatus string"
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    publish.replace_guarded(rows, target, schema)
    publish.replace_guarded(rows.filter("o_orderkey % 3 = 0"), target, schema)
    return storage.current(spark, target, schema)


@query("""with t as (select doc_id, lang, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) h, case doc_id % 3 when 0 then replace(coalesce(text, ''), 'e', 'E') when 1 then coalesce(text, '') else 'Other ' || coalesce(text, '') end || ' ·  Site' title from documents),
n as (select *, trim(regexp_replace(trim(regexp_replace(title, '\\s+', ' ', 'g')), '(?i)\\s*[|·]\\s*site$', '')) t from t)
select doc_id, sha256(case when h = '' or t = '' or lower(h) <> lower(t) then h else h || ' (' || case lang when 'en' then 'cross-border guide' when 'de' then 'Grenzgänger-Leitfaden' when 'fr' then 'guide frontalier' else 'guida frontaliere' end || ')' end) h1 from n""")
def localised_headings(spark, d):
    """whole texts as headings, against titles with a brand; tags by language."""
    text = F.coalesce("text", F.lit(""))
    title = F.concat(F.when(F.col("doc_id") % 3 == 0, F.replace(text, F.lit("e"), F.lit("E"))).when(F.col("doc_id") % 3 == 1, text).otherwise(F.concat(F.lit("Other "), text)), F.lit(" ·  Site"))
    return table(spark, d, "documents").select("doc_id", F.sha2(T.heading_apart(text, title, T.heading_tag(F.col("lang")), "Site"), 256).alias("h1"))


@query(_FOLDED_NAMES + """ select a.id from s a where a.id % 2 = 0 and exists (select 1 from s b where b.id % 2 = 1 and len(list_intersect(a.s, b.s)) >= 0.7 * (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))))""")
def names_near_others(spark, d):
    """Names of one half of the parts that are like some name of the other half."""
    sets = table(spark, d, "part").select(F.col("p_partkey").alias("id"), T.folded(T.similarity_tokens(F.col("p_name"))).alias("tokens"))
    return dedup.near_any(sets.filter("id % 2 = 0"), sets.filter("id % 2 = 1")).select("id")


@query("""with s as (select s_suppkey::varchar id, 'Nuovo-' || s_suppkey slug from supplier where s_suppkey % 9 <> 4)
select id, slug, concat_ws(chr(10), '  <url>', '    <loc>https://example.org/articoli-svizzera/' || slug || '/</loc>',
 case id::int % 3 when 0 then concat_ws(chr(10), '    <image:image>', '      <image:loc>https://cdn.example/a&amp;b.webp</image:loc>', '      <image:title>T &lt;' || id || '&gt;</image:title>', '      <image:caption>&quot;alt&quot;</image:caption>', '    </image:image>') end,
 '    <xhtml:link rel="alternate" hreflang="it" href="https://example.org/articoli-svizzera/' || slug || '/" />',
 case when id::int % 2 = 0 then '    <xhtml:link rel="alternate" hreflang="en" href="https://example.org/en/swiss-articles/e' || id || '/" />' end,
 '    <xhtml:link rel="alternate" hreflang="fr" href="https://example.org/fr/articles-suisse/f' || id || '/" />',
 '    <xhtml:link rel="alternate" hreflang="x-default" href="https://example.org/articoli-svizzera/' || slug || '/" />',
 '    <lastmod>' || case when id::int % 4 = 0 then '2024-02-02' else '2024-01-01' end || '</lastmod>', '    <changefreq>monthly</changefreq>', '    <priority>0.7</priority>', '  </url>') xml from s where id::int % 5 <> 3""")
def section_sitemap(spark, d):
    """A section's own paths, three locales, images by address, captions, dates; some articles have no slug and
    some are shadowed."""
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select(k, k.cast("string").alias("id"))
    text = lambda prefix: F.concat(F.lit(prefix), "id")
    slugs = s.filter(k % 9 != 4).select("id", F.lit("it").alias("locale"), text("Nuovo-").alias("slug")).unionByName(s.filter(k % 2 == 0).select("id", F.lit("en").alias("locale"), text("e").alias("slug")))
    slugs = slugs.unionByName(s.select("id", F.lit("fr").alias("locale"), text("f").alias("slug"))).unionByName(s.select("id", F.lit("de").alias("locale"), F.lit("").alias("slug")))
    registry = s.select("id", F.when(k % 3 == 0, "https://cdn.example/a&b.webp").alias("image"), F.when(k % 4 == 0, "2024-02-02").otherwise("").alias("updatedAt"), F.lit("2024-01-01").alias("date"))
    meta = s.select("id", F.lit("title").alias("field"), F.concat(F.lit("T <"), "id", F.lit(">")).alias("value")).unionByName(s.select("id", F.lit("imageAlt").alias("field"), F.lit('"alt"').alias("value")))
    return publish.sitemap_rows(registry, slugs, meta, s.filter(k % 5 == 3).select(text("Nuovo-").alias("slug")), "https://example.org", publish.SECTION_PATHS["svizzera"])
