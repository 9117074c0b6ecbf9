"""More registered queries: functions and operators over columns made from the driver's tables. The SQL says
the same in its own way, by splitting, lists and plain patterns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import numeric as N
from lectern.functions import predicates as P
from lectern.functions import site as S
from lectern.functions import text as T
from lectern.operators import audits, dedup, publish, upkeep
from lectern.operators.terms import joined_terms
from lectern.plans.queries import NOW, query, table
from lectern.sources import corpus
from lectern.storage import new_path


def now():
    return F.lit(NOW).cast("timestamp")


def sql_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


@query("""with d as (select doc_id, '# Head **' || lang || '** [link](http://u) ~~~' || chr(10) || '- item `c`' || chr(10) || chr(10) || '2. ' || text || ' **' md from documents),
s as (select doc_id, md, regexp_replace(regexp_replace(regexp_replace(md, '\\*\\*([^*\\n]+)\\*\\*', '\\1', 'g'), '\\*([^*\\n]+)\\*', '\\1', 'g'), '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g') a from d),
l as (select doc_id, md, array_to_string(list_transform(string_split(a, chr(10)), lambda x: regexp_replace(regexp_replace(regexp_replace(x, '^#{1,6}\\s+', ''), '^[-*+]\\s+', ''), '^\\d+\\.\\s+', '')), chr(10)) a from s)
select doc_id, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(a, '`([^`]+)`', '\\1', 'g'), '\\n{2,}', ' ', 'g'), chr(10), ' '), '\\s{2,}', ' ', 'g'), '^\\s+|\\s+$', '', 'g') plain,
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(md, '\\*\\*([^*\\n]+?)\\*\\*', '\\1', 'g'), '\\*{2,}', '', 'g'), '[_=~]{3,}', ' ', 'g'), '^\\s*\\*+\\s*', ''), '\\s*\\*+\\s*$', ''), '[ \\t]{2,}', ' ', 'g'), '^\\s+|\\s+$', '', 'g') title from l""")
def plain_markdown(spark, d):
    """F01, F02."""
    md = F.concat(F.lit("# Head **"), "lang", F.lit("** [link](http://u) ~~~\n- item `c`\n\n2. "), "text", F.lit(" **"))
    return table(spark, d, "documents").select("doc_id", T.markdown_to_plain(md).alias("plain"), T.literal_markdown_removed(md).alias("title"))


_DECODED = {"&amp;amp;lt;": "<", "&#39;": "’", "&hellip;": "…", "&amp;quot;": '"', "&nbsp;": " ", "&bogus;": "&bogus;", "&#8220;": "“"}


@query("with k as (select *, doc_id % 7 i from documents) select doc_id, lang || (" + sql_list(_DECODED.values()) + ")[i + 1] || source || (" + sql_list(list(_DECODED.values())[::-1]) + ")[i + 1] || chr(57344) || chr(63743) || coalesce(text, '') as decoded from k")
def decoded_entities(spark, d):
    """entities encoded once to three times, between plain words, private characters and whole texts."""
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % 7 + 1).cast("int"))
    text = F.concat("lang", pick(_DECODED), "source", pick(list(_DECODED)[::-1]), F.lit("\ue000\uf8ff"), F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", T.entities_decoded(text).alias("decoded"))


@query(r"""with p as (select page_id, html || '<meta property="og:title" content="' || page_id || '"><META name=''description'' content="x"><a href="/long' || page_id || '"> Maggiori informazioni su: a headline that is long <b>enough</b></a>' h from pages),
l as (select page_id, h, regexp_extract_all(h, '(?is)<a\b[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) hrefs, regexp_extract_all(h, '(?is)<a\b[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) texts from p),
t as (select page_id, h, hrefs, list_transform(texts, lambda x: trim(regexp_replace(trim(regexp_replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '(?i)^maggiori informazioni su\s*:?\s*', ''))) heads from l)
select page_id, sha256(regexp_replace(regexp_replace(h, '(?is)<script\b[^>]*>.*?</script>', '', 'g'), '(?is)<style\b[^>]*>.*?</style>', '', 'g')) quiet,
array_to_string(list_filter(regexp_extract_all(h, '(?is)<meta\b[^>]*>'), lambda x: regexp_matches(x, '(?i)(property|name)=["''](og:[^"'']+|description)["'']')), chr(10)) meta,
array_to_string(list_transform(list_filter(list_zip(hrefs, heads), lambda z: length(z[2]) >= 20), lambda z: z[1] || '=' || z[2]), '|') heads from t""")
def page_parts(spark, d):
    """F05, F06, F38."""
    extra = F.concat(F.lit('<meta property="og:title" content="'), F.col("page_id"), F.lit('"><META name=\'description\' content="x"><a href="/long'), F.col("page_id"), F.lit('"> Maggiori informazioni su: a headline that is long <b>enough</b></a>'))
    p = table(spark, d, "pages").select("page_id", F.concat("html", extra).alias("h"))
    heads = F.array_join(F.transform(S.headlines(F.col("h")), lambda s: F.concat(s["href"], F.lit("="), s["headline"])), "|")
    return p.select("page_id", F.sha2(T.scripts_removed(F.col("h")), 256).alias("quiet"), T.meta_tags(F.col("h")).alias("meta"), heads.alias("heads"))


@query(r"""with p as (select p_partkey, p_brand, 'it\''s \"' || p_name || '\" a\\n b\n c\t\q \\\\' || p_brand || chr(63743) e from part),
s as (select *, string_split(e, '\\') w from p)
select p_partkey, array_to_string(list_transform(w, lambda x: replace(replace(replace(replace(replace(x, '\''', ''''), '\"', '"'), '\n', chr(10)), '\r', ''), '\t', ' ')), '\') ts,
array_to_string(list_transform(w, lambda x: replace(replace(x, '\''', ''''), '\"', '"')), '\') meta,
regexp_replace(e, '\\+n', chr(10), 'g') repaired, replace('{"a":"<' || p_brand || '</script>"}', '<', '\u003c') script from s""")
def unescaped_values(spark, d):
    """F08, F09, F10, F12."""
    e = F.concat(F.lit("it\\'s \\\""), "p_name", F.lit("\\\" a\\\\n b\\n c\\t\\q \\\\\\\\"), "p_brand", F.lit("\uf8ff"))
    json = F.concat(F.lit('{"a":"<'), "p_brand", F.lit('</script>"}'))
    return table(spark, d, "part").select("p_partkey", T.ts_unescaped(e).alias("ts"), T.meta_unescaped(e).alias("meta"), T.double_breaks_repaired(e).alias("repaired"), T.script_json(json).alias("script"))


@query("""with t as (select doc_id, lang, text, '  ' || coalesce(text, '') || ' 😀' u, lang || '-' || replace(lower(left(text, 60)), ' ', '-') slug from documents)
select doc_id, left(text, 50) cut, case when length(coalesce(text, '')) <= 47 then trim(u) else left(coalesce(text, ''), 48) end emoji_cut,
case when length(slug) <= 30 then slug when substr(slug, 31, 1) in ('-', '') then left(slug, 30) when length(left(slug, 30)) - strpos(reverse(left(slug, 30)), '-') >= 22.5 and contains(left(slug, 30), '-') then left(slug, length(left(slug, 30)) - strpos(reverse(left(slug, 30)), '-')) else left(slug, 30) end short_slug,
left(lang || chr(10) || chr(10) || text, 4000) dedup from t""")
def cut_texts(spark, d):
    """A character beyond the basic plane counts as two units, and isn't split."""
    t = table(spark, d, "documents")
    slug = F.concat("lang", F.lit("-"), F.replace(F.lower(F.substring("text", 1, 60)), F.lit(" "), F.lit("-")))
    emoji = T.jsonld_description(F.concat(F.lit("  "), F.coalesce("text", F.lit("")), F.lit(" 😀")), 48)
    return t.select("doc_id", T.truncated_units(F.col("text"), 50).alias("cut"), emoji.alias("emoji_cut"), T.slug_truncated(slug, 30).alias("short_slug"), S.dedup_text(F.col("lang"), F.col("text")).alias("dedup"))


@query("""with p as (select p_partkey, case p_partkey % 3 when 0 then upper(p_name) when 1 then p_brand else '' end h1, p_name || ' | Site' title, case when p_partkey % 4 = 0 then p_name || ' in 2023' else p_name end d from part)
select p_partkey, case when p_partkey % 3 = 0 then h1 || ' (guide)' else h1 end h1, case when p_partkey % 4 = 0 or length(d) + 18 > 32 then d else d || ' Updated for 2026.' end as description from p""")
def headings(spark, d):
    """F18, F19."""
    k, name = F.col("p_partkey"), F.col("p_name")
    h1 = F.when(k % 3 == 0, F.upper(name)).when(k % 3 == 1, F.col("p_brand")).otherwise("")
    own = F.when(k % 4 == 0, F.concat(name, F.lit(" in 2023"))).otherwise(name)
    return table(spark, d, "part").select("p_partkey", T.heading_apart(h1, F.concat(name, F.lit(" | Site")), "guide", "Site").alias("h1"), T.description_boosted(own, "en", 2026, 32).alias("description"))


_CLAIMS = """select conv_id * 100 + turn id, case turn % 4 when 0 then 'Statistiche' when 1 then 'coerenza' when 2 then 'fonte' end category, case when turn % 5 = 4 then '' when turn % 5 = 3 then 'circa ' || conv_id || ',5 per cento' else text end claim from conversations"""


def _claims(spark, d):
    t = F.col("turn")
    category = F.when(t % 4 == 0, "Statistiche").when(t % 4 == 1, "coerenza").when(t % 4 == 2, "fonte")
    claim = F.when(t % 5 == 4, "").when(t % 5 == 3, F.concat(F.lit("circa "), F.col("conv_id"), F.lit(",5 per cento"))).otherwise(F.col("text"))
    return table(spark, d, "conversations").select((F.col("conv_id") * 100 + t).alias("id"), category.alias("category"), claim.alias("claim"))


@query(f"""with c as ({_CLAIMS}), t as (select *, coalesce(lower(category), '?') cat, lower(claim) raw, list_filter(list_filter(regexp_extract_all(strip_accents(lower(claim)), '[a-z0-9]+'), lambda x: length(x) >= 3), lambda x: not list_contains({sql_list(T.DOMAIN_STOPLIST)}, x)) w from c),
f as (select id, case when category is null or category not in ('statistiche', 'coerenza') then 1.0::double else 0.5::double end weight, case when raw = '' then cat || ':empty:' || id when regexp_matches(raw, '[0-9]') then cat || ':num:' || replace(regexp_extract(raw, '([0-9]+[.,][0-9]+|[0-9]+)', 1), ',', '.')
 when len(w) >= 2 then cat || ':words:' || array_to_string(list_sort(w[1:3]), '-') else cat || ':raw:' || regexp_replace(left(raw, 60), '\\s+', ' ', 'g') end fingerprint from t)
select fingerprint, max(weight) weight, count(*) n from f group by 1""")
def merged_claims(spark, d):
    """Claims of all models, one for each fingerprint."""
    return dedup.merged_issues(_claims(spark, d), T.claim_fingerprint(F.col("category"), F.col("claim"), F.col("id")), dedup.issue_weight(F.col("category")))


@query("""with c as (select conv_id, case turn % 3 when 0 then 'statistiche' when 1 then 'coerenza' else 'fonte' end category from conversations where turn % 4 <> 3)
select conv_id, sum(case when category = 'fonte' then 1.0 else 0.5 end)::double weight, sum(case when category = 'fonte' then 1.0 else 0.5 end) >= 3 blocked from c group by 1""")
def blocked_conversations(spark, d):
    """The issues that are kept, weighed by conversation."""
    t = F.col("turn")
    own = table(spark, d, "conversations").select("conv_id", F.when(t % 3 == 0, "statistiche").when(t % 3 == 1, "coerenza").otherwise("fonte").alias("category"), "turn")
    kept, _ = dedup.split_by(own, F.col("turn") % 4 == 3)
    return dedup.blocking_totals(kept, "conv_id", "category")


def _refuted(source: str, words: str) -> str:
    return f"length({source}) >= 100 and reason like '%non è presente%' and len(w) >= 4 and len(list_filter(w, lambda x: list_contains({words}, x))) >= 0.7 * len(w)"


@query(r"""with c as (select conv_id * 100 + turn id, case when turn % 2 = 0 then 'il dato non è presente nel testo' else 'va bene' end reason, text claim, lag(text) over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) source from conversations),
t as (select *, list_filter(regexp_extract_all(strip_accents(lower(claim)), '[a-z0-9]+'), lambda x: length(x) >= 3) w, list_filter(regexp_extract_all(strip_accents(lower(source)), '[a-z0-9]+'), lambda x: length(x) >= 3) s from c)
select id, """ + _refuted("claim", "w") + " refuted, " + _refuted("source", "s") + " refuted_before from t")
def refuted_issues(spark, d):
    """An issue says that a claim, a turn's whole text, isn't in the source: that turn itself, and the whole turn before it."""
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy(*[F.asc_nulls_first(c) for c in ("turn", "role", "text")]))
    c = table(spark, d, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.when(F.col("turn") % 2 == 0, "il dato non è presente nel testo").otherwise("va bene").alias("reason"), F.col("text").alias("claim"), before.alias("before"))
    return c.select("id", P.contradicted_by_source(F.col("claim"), F.col("reason"), F.col("claim")).alias("refuted"), P.contradicted_by_source(F.col("claim"), F.col("reason"), F.col("before")).alias("refuted_before"))


@query("""select conv_id * 100 + turn id, case when turn % 3 = 0 and conv_id not in (6, 7) then [conv_id, conv_id + 1, 7] when turn % 3 = 0 then [conv_id, conv_id + 1] when turn % 3 = 1 then [turn] else [] end::int[] refs from conversations""")
def closing_references(spark, d):
    """F37."""
    t, c = F.col("turn"), F.col("conv_id")
    text = F.when(t % 3 == 0, F.concat(F.lit("Fixes #"), c, F.lit(", #"), c + 1, F.lit(" e #7, then resolves: #"), c)).when(t % 3 == 1, F.concat(F.lit("chiude: #"), t, F.lit(" but not #99"))).otherwise(F.concat(F.lit("see #"), c, F.lit(" prefixes #4")))
    return table(spark, d, "conversations").select((c * 100 + t).alias("id"), F.array_distinct(T.closing_references(text)).alias("refs"))


@query("""select p_partkey, list_filter([p_name, trim(p_brand), p_type], lambda x: x <> '') parts, string_split(p_name, ' ') words, list_filter(string_split(regexp_replace(lower(p_name || '-' || p_type), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 4) file_words from part""")
def lists_of_names(spark, d):
    """F39, F34."""
    listed = F.concat(F.lit(" "), "p_name", F.lit(" ,, "), "p_brand", F.lit(",\t"), "p_type", F.lit(","))
    file = F.concat(F.lit("/images/blog/"), "p_name", F.lit("-"), "p_type", F.lit(".webp"))
    return table(spark, d, "part").select("p_partkey", T.comma_list(listed).alias("parts"), T.comma_list(F.replace("p_name", F.lit(" "), F.lit(", "))).alias("words"), T.filename_words(file).alias("file_words"))


@query(r"""with s as (select doc_id, string_split(regexp_replace(text || ' Quota of 12,5 percent. End', '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) s, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) t from documents)
select doc_id, list_filter(s, lambda x: contains(replace(x, ',', '.'), '12.5'))[1] percent, list_filter(t, lambda x: contains(x, 'the'))[1] word from s""")
def evidence(spark, d):
    """F40."""
    text = F.concat("text", F.lit(" Quota of 12,5 percent. End"))
    return table(spark, d, "documents").select("doc_id", S.evidence_sentence(text, F.lit("12.5"), percent=True).alias("percent"), S.evidence_sentence(F.col("text"), F.lit("the")).alias("word"))


@query(r"""with q as (select doc_id, case doc_id % 5 when 0 then 'cerco lavoro ' || lang when 1 then 'Annunci frontalieri ' || lang when 2 then ' ' when 3 then 'What is ' || lang else 'Whatever ' || lang || '?' end s, case doc_id % 4 when 0 then 'è un falso positivo' when 1 then 'non è un falso positivo' when 2 then 'not a false positive' end f from documents)
select doc_id, doc_id % 5 not in (0, 2) articleable, doc_id % 5 in (3, 4) faq, coalesce(doc_id % 4 = 0, false) false_positive from q""")
def intents(spark, d):
    """P06, P07, P16."""
    k, lang = F.col("doc_id"), F.col("lang")
    s = F.when(k % 5 == 0, F.concat(F.lit("cerco lavoro "), lang)).when(k % 5 == 1, F.concat(F.lit("Annunci frontalieri "), lang)).when(k % 5 == 2, " ").when(k % 5 == 3, F.concat(F.lit("What is "), lang)).otherwise(F.concat(F.lit("Whatever "), lang, F.lit("?")))
    f = F.when(k % 4 == 0, "è un falso positivo").when(k % 4 == 1, "non è un falso positivo").when(k % 4 == 2, "not a false positive")
    return table(spark, d, "documents").select("doc_id", P.articleable(s).alias("articleable"), P.faq_heading(s).alias("faq"), S.declared_false_positive(f).alias("false_positive"))


@query(r"""with t as (select doc_id, text || repeat('中', (doc_id % 200)::int) u from documents), n as (select doc_id, len(regexp_extract_all(u, '\p{L}')) l, (doc_id % 200) o from t)
select doc_id, round(case when l = 0 then 0 else o / l::double end, 9) ratio, case when l = 0 then 0 else o / l::double end > 0.1 other from n""")
def script_ratios(spark, d):
    """P08."""
    u = F.concat("text", F.expr("repeat('中', cast(doc_id % 200 as int))"))
    return table(spark, d, "documents").select("doc_id", F.round(P.other_script_ratio(u), 9).alias("ratio"), P.other_script(u).alias("other"))


@query("""with n as (select *, row_number() over (order by event_id) k from events) select event_id, case event_id % 4 when 0 then 'https://cdn.example/images/blog/a' || event_id || '.webp' when 1 then 'https://www.example.org/images/blog/b.png x' when 2 then 'see https://cdn.example/images/blog/c.jpg' else '/images/other/d.gif' end src,
event_id % 4 in (0, 1) leak, event_id % 4 = 2 asset, case when event_id % 2 = 0 then 'index ab-_' || (1000 + event_id % 9000) || ' js' end hashed from n""")
def image_references(spark, d):
    """F21, P09, P10, P11."""
    k = F.col("event_id")
    src = F.when(k % 4 == 0, F.concat(F.lit("/images/blog/a"), k, F.lit(".webp"))).when(k % 4 == 1, "https://www.example.org/images/blog/b.png x").when(k % 4 == 2, "see https://cdn.example/images/blog/c.jpg").otherwise("/images/other/d.gif")
    html = F.when(k % 4 == 0, F.concat(F.lit('<img src="/images/blog/a'), k, F.lit('.webp">'))).when(k % 4 == 1, "url(https://www.example.org/images/blog/b.png)").when(k % 4 == 2, '<script src="/assets/index-abc.js"></script><img src="/images/blog/thumbnails/x.webp">').otherwise('<img src="https://cdn.example/images/blog/c.jpg">')
    name = F.when(k % 2 == 0, F.concat(F.lit("index-ab-_"), 1000 + k % 9000, F.lit(".js"))).otherwise(F.concat(F.lit("index-"), k, F.lit(".png")))
    return table(spark, d, "events").select("event_id", T.image_value_to_cdn(src, "https://cdn.example/").alias("src"), S.image_leak(html, "https://www.example.org").alias("leak"), S.same_origin_asset(html).alias("asset"), F.concat_ws(" ", S.hashed_name(name)["name"], S.hashed_name(name)["hash"], S.hashed_name(name)["type"]).alias("h")).withColumn("hashed", F.nullif("h", F.lit(""))).drop("h")


@query("""with p as (select p_partkey, p_brand || '-' || p_partkey slug, 'https://x/' || p_partkey || '/' own from part)
select p_partkey, case when p_partkey % 3 = 0 then 'https://w/en/best-' || p_partkey || '/' else own end canonical, case when p_partkey % 3 = 0 then 'best-' || p_partkey end winner_slug,
case p_partkey % 4 when 0 then 'b.md' when 1 then 'new/z/' || p_partkey when 2 then 'short/' || p_partkey else 'x/' || p_partkey end path from p""")
def canonical_addresses(spark, d):
    """J06, J07, S03, S05, S06."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select("p_partkey", F.concat("p_brand", F.lit("-"), k).alias("slug"))
    maps = p.select(F.to_json(F.struct(F.map_from_arrays(F.array("slug"), F.array(F.when(k % 3 == 0, F.concat(F.lit("https://w/en/best-"), k, F.lit("/"))).otherwise("not an address"))).alias("overrides"))).alias("json"))
    done = publish.canonical_urls(p, corpus.overrides(maps, "json"), F.concat(F.lit("https://x/"), k, F.lit("/")))
    old = F.when(k % 4 == 0, "a.md").when(k % 4 == 1, F.concat(F.lit("old/deep/z/"), k)).when(k % 4 == 2, F.concat(F.lit("old/"), k)).otherwise(F.concat(F.lit("x/"), k))
    return done.select("p_partkey", "canonical", "winner_slug", corpus.remapped(old, {"a.md": "b.md"}, [("old/deep/", "new/"), ("old/", "short/")]).alias("path"))


@query(f"""with e as (select *, epoch_us(timestamp '{NOW}') - epoch_us(ts) us, event_id % 2 = 0 draft from events)
select event_id, draft and us > 48 * 3600000000 and event_id % 3 <> 0 parked, event_id % 4 in (0, 1) triggered, event_id % 5 <> 0 and event_id % 2 = 1 and event_id % 7 <> 0 open_pr, event_id % 600 = 429 or event_id % 600 >= 500 again,
1000.0 * power(2, event_id % 5) wait, case when event_id % 2 = 0 then us / 8.64e10 end >= 3 and event_id % 2 = 0 stranded, event_id % 3 = 1 mine, least(240, 26 + 8 * (event_id % 40)) turns from e""")
def upkeep_rules(spark, d):
    """P15, P20-P24, A14."""
    k = F.col("event_id")
    draft = k % 2 == 0
    labels = F.when(k % 3 == 0, F.array(F.lit("needs-human"))).otherwise(F.array(F.lit("x")))
    path = F.when(k % 4 == 0, "content/a/b").when(k % 4 == 1, "package.json").when(k % 4 == 2, "contents/a").otherwise("src/package.json")
    days = S.stranded_days(F.when(draft, "identical").otherwise("adapted"), F.lit("site-ahead"), F.col("ts").cast("string"), now())
    login = F.when(k % 3 == 1, "app/helper").when(k % 3 == 2, "other[bot]").otherwise(F.lit(None))
    number = F.when(k % 7 == 0, "n/a").otherwise(k.cast("string"))
    return table(spark, d, "events").select(
        "event_id", P.parked_draft(draft, F.col("ts").cast("string"), labels, now()).alias("parked"), P.under_path(path, ["content/"], ["package.json"]).alias("triggered"),
        S.sweepable(F.when(k % 5 == 0, "merged").otherwise("open"), draft, number).alias("open_pr"), P.retryable(k % 600).alias("again"), P.backoff_ms(k % 5 + 1).alias("wait"),
        S.stranded(days).alias("stranded"), S.by_author(login, ["helper", "someone"]).alias("mine"), S.turn_budget(k % 40).cast("long").alias("turns"),
    )


@query(f"""with e as (select *, value - 20 v, (epoch_us(timestamp '{NOW}') - epoch_us(ts)) / 6e7 m from events)
select event_id, round(case when v > 0 then least(100, 25 * log10(v + 1)) else 0 end, 9) trend, floor(greatest(m, 0) + 0.5)::bigint as "minutes", floor(greatest(v, 0) + 0.5)::bigint || ' min' as said,
case when floor(abs(v) + 0.5) = 0 then '±0 min' else case when v > 0 then '+' else '−' end || floor(abs(v) + 0.5)::bigint || ' min' end delta, least(95, greatest(60, floor(value)))::int quota, strftime(ts, '%Y-%m-%d') || 'T00:00:00.000Z' stamp from e""")
def numbers_and_times(spark, d):
    """F50, F52-F55."""
    v = F.col("value") - 20
    return table(spark, d, "events").select("event_id", F.round(N.trend_score(v), 9).alias("trend"), N.minutes_since(F.col("ts").cast("string"), now()).alias("minutes"), N.minutes_text(v).alias("said"), N.minutes_delta_text(v).alias("delta"), N.clamped_quota(F.col("value")).alias("quota"), S.day_stamp(F.col("ts")).alias("stamp"))


@query("""select vec_id, round(list_sum(list_transform(embedding, lambda x: x::double * x::double)) / nullif(list_sum(list_transform(embedding, lambda x: x::double * x::double)), 0), 6) length, round(embedding[1]::double / sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 9) as first from embeddings""")
def unit_vectors(spark, d):
    """F56."""
    u = N.unit_vector(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", u.alias("u")).select("vec_id", F.round(N.dot(F.col("u"), F.col("u")), 6).alias("length"), F.round(F.get("u", 0), 9).alias("first"))


@query("""select o_orderkey, h % 97 as bucket, h from (select o_orderkey, list_reduce(list_prepend(2166136261::hugeint, [55357::hugeint, 56832::hugeint, (48 + o_orderkey % 10)::hugeint]), lambda h, c: (xor(h, c) * 16777619) % 4294967296)::bigint h from orders)""")
def hash_buckets(spark, d):
    """F46 beyond the basic plane, and its modulo."""
    text = F.concat(F.lit("😀"), (F.col("o_orderkey") % 10).cast("string"))
    return table(spark, d, "orders").select("o_orderkey", N.fnv1a32_mod(text, 97).alias("bucket"), N.fnv1a32(text).alias("h"))


@query("""select sum(event_id % 7 + event_id % 5 + event_id % 3 + 1)::bigint total_tokens from events""")
def usage_total(spark, d):
    """Logs of lines, bad ones among them, in which no result stands."""
    k, path = F.col("event_id"), new_path(spark, "logs")
    line = F.to_json(F.struct(F.lit("assistant").alias("type"), F.struct(F.struct((k % 7).alias("input_tokens"), (k % 5).alias("cache_creation_input_tokens"), (k % 3).alias("cache_read_input_tokens"), F.lit(1).alias("output_tokens")).alias("usage")).alias("message")))
    table(spark, d, "events").select(F.concat(line, F.when(k % 50 == 0, "\n{bad").otherwise("")).alias("value")).write.text(path)
    return audits.usage_totals(upkeep.logged_messages(spark, path))


@query("""select user_id % 50 as u, coalesce(arg_max(round(value)::bigint, event_id) filter (event_type = 'error'), sum(round(value)::bigint))::bigint total_tokens from events group by 1""")
def usage_of_results(spark, d):
    """The last result record wins over the sum, for each of fifty users' logs; errors stand in for results."""
    own = table(spark, d, "events").select((F.col("user_id") % 50).alias("u"), F.col("event_id").alias("ordinal"), F.when(F.col("event_type") == "error", "result").otherwise("assistant").alias("type"), F.round("value").cast("long").alias("input_tokens"), *[F.lit(None).cast("long").alias(c) for c in ("cache_creation_input_tokens", "cache_read_input_tokens", "output_tokens")])
    return audits.usage_totals(own, "ordinal", "u")


@query("""select h as "key", count(*) n from (select sha256(text) h from documents) group by 1 having count(*) > 1""")
def duplicate_texts(spark, d):
    """A06."""
    return audits.duplicates(table(spark, d, "documents").select(F.sha2("text", 256).alias("key")), "key")


@query("""select event_id, case event_id % 3 when 0 then 'unavailable' when 1 then 'firing' else 'quiet' end alert from events where (select count(*) > 0 and count(ts) > 0 from events)""")
def alerts(spark, d):
    """The events are dated, so they may be published."""
    k = F.col("event_id")
    rows = audits.publishable(table(spark, d, "events").select("event_id", F.col("ts").cast("string").alias("date")), "date")
    return audits.shadow_alert(rows.withColumn("count", F.when(k % 3 == 0, "n/a").when(k % 3 == 1, " 12 ").otherwise("0")), "count").select("event_id", "alert")


_ITEM = """'<item><title>' || replace(p_name, '&', '&amp;') || '</title><link>https://example.org/it/' || p_partkey || '&amp;x/</link><guid isPermaLink="false">' || p_partkey || '&lt;id</guid></item>'"""


@query(f"""select p_partkey || '<id' id, {_ITEM} xml from part""")
def feed_items(spark, d):
    """K02."""
    k = F.col("p_partkey").cast("string")
    return publish.feed_items(table(spark, d, "part").select(F.concat(k, F.lit("<id")).alias("id"), F.concat(k, F.lit("&x")).alias("slug"), F.col("p_name").alias("title")), "https://example.org", "/it/")


@query("""with t as (select o_orderkey, o_orderdate, '<item>' || o_orderkey || '</item>' x from orders order by o_orderdate desc, o_orderkey limit 20)
select '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<rss version="2.0"><channel><title>A &amp; B</title><link>https://example.org</link><description>d</description><language>it</language>' || chr(10) || string_agg(x, chr(10) order by o_orderdate desc, o_orderkey) || chr(10) || '</channel></rss>' || chr(10) as xml from t""")
def feed_channel(spark, d):
    """A whole channel of the newest rows."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.concat(F.lit("<item>"), F.col("o_orderkey"), F.lit("</item>")).alias("xml"))
    return publish.feed_document(rows, "A & B", "https://example.org", "d", "it", "o_orderdate", "o_orderkey", 20)


@query(f"""with n as (select *, row_number() over (order by p_partkey) k from part)
select ((k - 1) // 300)::int as file, count(*) as count, '{publish.URLSET}' || string_agg('<url>' || p_partkey || '</url>', chr(10) order by p_partkey) || chr(10) || '</urlset>' || chr(10) as xml from n group by 1""")
def sitemap_files(spark, d):
    """Whole documents of 300 addresses at most."""
    return publish.sitemap_documents(table(spark, d, "part").select(F.col("p_partkey").alias("ordinal"), F.concat(F.lit("<url>"), F.col("p_partkey"), F.lit("</url>")).alias("xml")), per_file=300)


@query("""select c_custkey, row_number() over (order by case c_mktsegment when 'MACHINERY' then 0 when 'BUILDING' then 1 else 2 end, c_custkey) as position from customer""")
def preferred_customers(spark, d):
    """Segments stand in for names."""
    return publish.preferred_order(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), ["MACHINERY", "BUILDING"], "c_mktsegment", "c_custkey").select("c_custkey", "position")


@query("""select 'f' || s_suppkey as name, case s_suppkey % 3 when 0 then 'f' || s_suppkey || '.js' when 1 then 'f' || s_suppkey || '-AAAAaaaa.js' end as file from supplier""")
def chunk_files(spark, d):
    """O05, F36."""
    s = table(spark, d, "supplier").select(F.concat(F.lit("f"), F.col("s_suppkey")).alias("name"), (F.col("s_suppkey") % 3).alias("m"))
    hashed = s.filter("m < 2").select(F.explode(F.array(F.concat("name", F.lit("-BBBBbbbb.js")), F.concat("name", F.lit("-AAAAaaaa.js")))).alias("file"))
    return upkeep.first_candidates(hashed.union(s.filter("m = 0").select(F.concat("name", F.lit(".js")))), s.select("name"))


@query("""with k as (select * from nation, (values ('it', ''), ('de', '/de')) l(locale, prefix)) select 'n' || n_nationkey as section, locale, lower(n_name) || '-' || locale slug, prefix || '/' || lower(n_name) || '-' || locale || '/all/' path from k""")
def section_hubs(spark, d):
    """A slug of any locale names its section, and has its path."""
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey")).alias("section"), F.create_map(*[x for loc in ("it", "de") for x in (F.lit(loc), F.concat(F.lower("n_name"), F.lit(f"-{loc}")))]).alias("index_slugs"))
    return upkeep.hub_slugs(n).withColumn("path", S.hub_path(F.col("locale"), F.col("slug"), F.lit("all")))


@query("""select page_id, '{"@type":"ImageObject","contentUrl":"https://x/' || page_id || '.webp","url":"https://x/' || page_id || '.webp","acquireLicensePage":"https://x/l","copyrightNotice":"© 2024–2026 Own. Tutti i diritti riservati.","license":"https://x/l","creator":{"@type":"Organization","name":"' || case when page_id % 2 = 0 then 'Own","url":"https://x' else 'Other' end || '"},"creditText":"' || case when page_id % 2 = 0 then 'Own' else 'Other' end || '"}' as image,
case when page_id % 3 = 0 then 'NULL' else sha256(url) end as digest from pages""")
def image_objects(spark, d):
    """F58, F59, F62."""
    k = F.col("page_id")
    return table(spark, d, "pages").select("page_id", S.image_object(F.concat(F.lit("https://x/"), k, F.lit(".webp")), "Own", "https://x", "https://x/l", 2026, F.when(k % 2 == 0, "Own").otherwise("Other")).alias("image"), S.contribution_digest(F.when(k % 3 != 0, F.col("url"))).alias("digest"))


@query(r"""with p as (select page_id, '/to/' || page_id u, coalesce(nullif(trim(regexp_extract(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>', '', 'g'), '(?is)<style\b[^>]*>.*?</style>', '', 'g'), '(?i)<title[^>]*>([^<]+)</title>', 1)), ''), 'Redirecting to /to/' || page_id) t from pages)
select page_id, concat_ws(chr(10), '<!DOCTYPE html>', '<html lang="it">', '<head>', '<meta charset="utf-8">', '<title>' || t || '</title>', '<link rel="canonical" href="' || u || '">', '<meta name="robots" content="noindex,follow">', '<script>location.replace("' || u || '" + window.location.search + window.location.hash)</script>', '</head>', '<body><h1>' || t || '</h1><a href="' || u || '">Continua su ' || u || '</a></body>', '</html>') page from p""")
def bridge_pages(spark, d):
    """the tables' pages have no tags to carry over."""
    return table(spark, d, "pages").select("page_id", S.bridge_page(F.col("html"), F.concat(F.lit("/to/"), F.col("page_id"))).alias("page"))


@query("""select event_id, case when event_id % 5 = 0 then 'backlog' when event_id % 4 = 0 then 'publish' when event_id % 4 = 1 then 'generation' when event_id % 4 = 2 then 'engine' else 'other' end category,
case when event_id % 5 = 0 or event_id % 7 = 0 then 'none' when event_id % 4 = 0 then 'fix' else 'queue' end route, case when event_id % 5 = 0 or event_id % 7 = 0 or event_id % 4 = 0 then null when event_id % 4 = 2 then 'high' when event_id % 4 = 1 then 'low' else 'normal' end prio from events""")
def issue_classes(spark, d):
    """F41."""
    k = F.col("event_id")
    title = F.when(k % 4 == 0, "Publish article data failed").when(k % 4 == 1, "Generate blog failed").when(k % 4 == 2, "engine broke").otherwise("?")
    labels = F.array_compact(F.array(F.when(k % 5 == 0, "backlog"), F.when(k % 7 == 0, "crawler-transient")))
    return table(spark, d, "events").select("event_id", S.issue_class(title, labels).alias("c")).select("event_id", "c.category", "c.route", F.col("c.fuPrio").alias("prio"))


@query("""select event_id, case when event_id % 5 = 0 then 'corpus-only' when event_id % 5 = 1 then case when event_id % 4 = 0 then 'corpus-only-pending' else 'corpus-only-pending-landed' end
when event_id % 4 = 0 then 'site-ahead' when event_id % 4 = 1 then 'stable' when event_id % 4 = 2 then 'both-moved' else 'corpus-ahead' end state,
case when event_id % 6 = 0 then 'unchecked' when event_id % 6 = 1 then 'current' when event_id % 6 = 2 then 'unchecked' when event_id % 6 = 3 then 'history' when event_id % 6 = 4 then 'ghost' else 'unresolved' end origin from events""")
def drift_states(spark, d):
    """hashes are letters; the baseline is a, a."""
    k = F.col("event_id")
    mode = F.when(k % 5 == 0, "corpus-only").when(k % 5 == 1, "corpus-only-pending").otherwise("identical")
    site = F.when(k % 4 == 0, F.when(k % 5 != 1, "b")).when(k % 4 == 2, "b").otherwise("a")
    own = F.when(k % 4 >= 2, "c").otherwise("a")
    drift = S.drift_class(mode, site, own, F.lit("a"), F.lit("a"), F.lit(None).cast("string"))
    seen = F.when(k % 6 == 3, True).when(k % 6 >= 4, False)
    return table(spark, d, "events").select("event_id", drift["state"].alias("state"), S.provenance(F.when(k % 6 != 0, "x"), F.when(k % 6 == 1, "x").otherwise("y"), seen, k % 6 == 4).alias("origin"))


@query("""with q as (select *, trim(p_name) h, row_number() over (partition by lower(trim(p_name)) order by p_partkey) n from part) select h headline, p_retailprice imp, p_size::double pos, 0.0::double ctr, 0.0::double clicks, 'orphan' as source from q where n = 1""")
def orphan_queries(spark, d):
    """Part names stand in for queries."""
    q = table(spark, d, "part").select(F.col("p_partkey").alias("ordinal"), F.concat(F.lit(" "), "p_name").alias("query"), F.col("p_retailprice").cast("string").alias("imp"), F.col("p_size").cast("string").alias("pos"), F.lit("n/a").alias("ctr"), F.lit(None).cast("string").alias("clicks"))
    return corpus.orphan_candidates(q)


_TRENDS = """with t as (select p_partkey, 'Frontaliere ' || p_name || ' ' || p_partkey % 400 k, p_size from part where p_partkey % 3 <> 0), f as (select *, row_number() over (partition by lower(k) order by p_partkey) n from t)
select k headline, 'trends' as source, round(case when p_size > 10 then least(100, 25 * log10(p_size - 10 + 1)) else 0 end, 9) score, nullif(p_size - 10, 0)::double as "rawScore", 'IT' geo, null::varchar seed from f where n = 1 and lower(k) not in (select lower('frontaliere ' || p_name || ' ' || p_partkey % 400) from part where p_partkey % 10 = 0)"""


@query(_TRENDS)
def trends(spark, d):
    """Those without an anchor and the proven ones go."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    name = F.concat(F.when(k % 3 == 0, "Xx ").otherwise("Frontaliere "), "p_name", F.lit(" "), k % 400)
    rows = p.select(k.alias("ordinal"), name.alias("keyword"), (F.col("p_size") - 10).cast("string").alias("score"), F.lit("IT").alias("geo"), F.lit(None).cast("string").alias("seed"))
    proven = p.filter("p_partkey % 10 = 0").select(F.concat(F.lit(" frontaliere "), "p_name", F.lit(" "), k % 400).alias("query"))
    return corpus.trend_candidates(rows, proven, lambda c: S.anchor(c).isNotNull()).withColumn("score", F.round("score", 9))


@query("""select p_name || ' ' || p_partkey headline from part where p_partkey % 10 <> 0 and contains(p_name, 'e')""")
def unproven_suggestions(spark, d):
    """S09, J08."""
    p = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(" "), F.col("p_partkey")).alias("headline"))
    return corpus.unproven(p, p.filter("p_partkey % 10 = 0").select(F.upper(F.concat(F.lit(" "), "headline")).alias("query")), "e").select("headline")


@query(f"""select 'https://a/' || event_id url, 'A headline of ' || event_type headline, ts as date, 'wp-search:a' source from events where epoch_us(timestamp '{NOW}') - epoch_us(ts) <= 7 * 86400000000 and event_id % 4 = 0""")
def recent_posts(spark, d):
    """Too short, without link, or without date."""
    k = F.col("event_id")
    posts = table(spark, d, "events").select(F.lit("a").alias("host"), F.when(k % 4 == 1, "short").otherwise(F.concat(F.lit("<b>A headline</b> of&nbsp;"), "event_type")).alias("title"), F.when(k % 4 != 2, F.concat(F.lit(" https://a/"), k)).alias("link"), F.when(k % 4 == 3, "never").otherwise(F.col("ts").cast("string")).alias("date"))
    return upkeep.post_headlines(posts, now())


@query("""select '/i/' || p_name || p_partkey || '.WEBP' path, list_filter(string_split(regexp_replace(lower(p_name || p_partkey), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 4) words from part where p_partkey % 4 = 0 and p_partkey % 8 <> 0 and len(list_filter(string_split(regexp_replace(lower(p_name || p_partkey), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 4)) > 0""")
def catalog_entries(spark, d):
    """Images that the catalog lacks."""
    k = F.col("p_partkey")
    path = F.concat(F.lit("/i/"), F.when(k % 4 == 2, "a b").otherwise(F.concat("p_name", k)), F.when(k % 2 == 0, ".WEBP").otherwise(".png"))
    p = table(spark, d, "part").select("p_partkey", path.alias("path"))
    return upkeep.catalog_entries(p.filter("p_partkey % 2 = 0 or p_partkey % 3 = 0"), p.filter("p_partkey % 8 = 0"))


@query("""select event_id, case when event_id % 3 = 0 then 1 else 2 end as version, case when event_id % 3 = 0 then 0 else event_id end + 1 as "runCounter", case when event_id % 3 = 0 then 80 else least(95, greatest(60, event_id % 120)) end::int as "currentQuota" from events""")
def quota_counters(spark, d):
    """Bad states have defaults; the counter goes up after a success."""
    k = F.col("event_id")
    raw = table(spark, d, "events").select(F.when(k % 3 == 0, "{bad").otherwise(F.to_json(F.struct(F.lit(2).alias("version"), k.alias("runCounter"), (k % 120).alias("currentQuota"), k.cast("string").alias("lastTune")))).alias("value"), "event_id")
    done = upkeep.counted(upkeep.quota_states(raw, keep=("event_id",)))
    return done.select("event_id", "version", "runCounter", "currentQuota")


@query("""select o_orderkey, case when o_orderkey % 5 = 0 then 'bad date' when o_orderkey % 2 = 0 then 'ok' else 'not registered' end verdict from orders""")
def repair_verdicts(spark, d):
    """K10."""
    k = F.col("o_orderkey")
    dates = table(spark, d, "orders").select("o_orderkey", F.when(k % 5 == 0, "31.1.2024").otherwise("2024-01-31").alias("date"))
    registered = dates.filter("o_orderkey % 2 = 0").select(k.cast("string").alias("id"))
    return upkeep.repairs(dates, registered, k.cast("string")).select("o_orderkey", "verdict")


@query("""with u as (select c_mktsegment section, 'c' || c_custkey id from customer where c_custkey % 3 <> 0 union select c_mktsegment, 'c' || c_custkey from customer where c_custkey % 2 = 0) select section, greatest(1, ceil(count(*) / 100.0))::bigint pages from u group by 1""")
def section_archives(spark, d):
    """Ids that titles in Italian or slugs name."""
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("section"), F.concat(F.lit("c"), F.col("c_custkey")).alias("id"), F.col("c_custkey").alias("k"))
    meta = c.select("section", F.when(F.col("k") % 3 == 0, "de").otherwise("it").alias("locale"), "id")
    return dedup.archive_page_counts(dedup.archive_ids(meta, c.filter("k % 2 = 0").select("section", "id")))


@query("""with r as (select event_type as name, avg(case when value > 50 then 1.0 else 0.0 end) rate from events group by 1), c as (select event_type as name, row_number() over (order by event_type) ordinal from (select distinct event_type from events) union all select 'unused', 0)
select name, coalesce(rate, 0.5) rate, row_number() over (order by coalesce(rate, 0.5) desc, ordinal) as position from c left join r using (name)""")
def ranked_choices(spark, d):
    """One choice was never tried."""
    events = table(spark, d, "events").select(F.col("event_type").alias("name"), (F.col("value") > 50).alias("ok"))
    names = sorted(r["name"] for r in events.select("name").distinct().collect())  # a handful of types
    chain = spark.createDataFrame([("unused", 0), *((n, i + 1) for i, n in enumerate(names))], "name string, ordinal int")
    return audits.ranked(chain, events).select("name", "rate", F.col("position").cast("long").alias("position"))


@query("""select p_partkey, p_partkey % 3 = 0 anchored from part""")
def unambiguous_anchors(spark, d):
    """P04."""
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" e la LAMal"))).otherwise(F.concat(F.lit("frontalieri "), "p_name"))
    return table(spark, d, "part").select("p_partkey", S.anchor(text, unambiguous=True).isNotNull().alias("anchored"))


@query(f"""select event_id, epoch_us(timestamp '{NOW}') - epoch_us(ts) between 0 and 48 * 3600000000 and event_id % 2 = 0 eligible from events""")
def eligible_news(spark, d):
    """P01 with dates, P02: the fixed topics."""
    word = F.when(F.col("event_id") % 2 == 0, "Nuova Imposta alla fonte").otherwise("hockey")
    none = F.lit(None).cast("string")
    return table(spark, d, "events").select("event_id", P.news_eligible(none, word, none, none, F.lit(None).cast("array<string>"), F.col("ts").cast("string"), now(), S.NEWS_TOPICS).alias("eligible"))


_STEM = "case when length(x) < 4 then x " + " ".join(f"when ends_with(x, '{e}') and length(x) >= {len(e) + 3} then left(x, length(x) - {len(e)})" for e in T.SUFFIXES) + " else x end"


def _grams(n: int) -> str:
    return "list_filter(list_transform(range(1, len(w) - %d), lambda i: %s), lambda g: length(g) >= 6)" % (n - 2, " || ' ' || ".join(f"w[i + {k}]" for k in range(n)))


@query(rf"""with t as (select doc_id, list_filter(string_split_regex(lower(strip_accents(text)), '[\s\p{{P}}\p{{S}}]+'), lambda x: x <> '') w from documents),
u as (select doc_id, w, list_filter(w, lambda x: length(x) >= 3 and not list_contains({sql_list(T.STOPWORDS)}, x)) u from t)
select doc_id, array_to_string(list_sort(list_distinct(u)), '|') unigrams, array_to_string(list_sort(list_distinct({_grams(2)})), '|') bigrams,
array_to_string(list_sort(list_distinct({_grams(3)})), '|') trigrams, array_to_string(list_sort(list_distinct(list_transform(u, lambda x: {_STEM}))), '|') stems from u""")
def sorted_terms(spark, d):
    """F26-F29 but for proper nouns, of each whole text, in order of the alphabet."""
    return joined_terms(table(spark, d, "documents").select("doc_id", "text"), names=["unigrams", "bigrams", "trigrams", "stems"])


@query(r"""with t as (select doc_id, list_filter(string_split_regex(text, '[\s\p{P}\p{S}]+'), lambda x: x <> '') w from documents),
e as (select doc_id, unnest(w) r, generate_subscripts(w, 1) i from t), c as (select doc_id, lower(strip_accents(r)) n, i from e where i > 1 and regexp_matches(r, '^\p{Lu}')),
s as (select doc_id, n, i, i - row_number() over (partition by doc_id order by i) run from c), p as (select doc_id, string_agg(n, ' ' order by i) n from s group by doc_id, run having count(*) > 1),
u as (select doc_id, n from c union select doc_id, n from p), g as (select doc_id, string_agg(n, '|' order by n) nouns from u group by doc_id)
select doc_id, coalesce(nouns, '') nouns from documents left join g using (doc_id)""")
def proper_nouns(spark, d):
    """capitalised tokens but the first of each whole text, and runs of them, in order of the alphabet."""
    return joined_terms(table(spark, d, "documents").select("doc_id", "text"), names=["properNouns"]).withColumnRenamed("properNouns", "nouns")
