import datetime
import time

import pytest
from pyspark.sql import functions as F

from lectern.functions import numeric as N
from lectern.functions import predicates as P
from lectern.functions import text as T
from lectern.operators import audits, dedup, publish
from lectern.operators.terms import text_terms
from lectern.sources import corpus


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (0,)], list(values) or ["x"])
    return row.select(column.alias("r")).collect()[0]["r"]


@pytest.mark.parametrize(
    "f, given, wanted",
    [
        (T.markdown_to_plain, "## Head\n\n**bold** and *it* [link](nav:x)\n- item\n1. two `code`", "Head bold and it link item two code"),
        (T.literal_markdown_removed, "** A **b**c  d ===", "A bc d"),
        (T.entities_decoded, "a &amp;lt; b &#39;c&nbsp;d", "a < b ’c d"),
        (T.html_to_text, "<p>A&amp;B&nbsp;&eacute; c</p>", "A&B c"),
        (T.scripts_removed, "a<script>x</script>b<STYLE>y</STYLE>c", "abc"),
        (T.ts_unescaped, r"a\nb\'c\\nd\q", "a\nb'c\\nd\\q"),
        (T.xml_escaped, "a&b<c>\"d'", "a&amp;b&lt;c&gt;&quot;d'"),
        (T.publisher_host, "https://WWW.Example.org/a?b", "example.org"),
        (T.crossing_slug, "Chiasso – Brogeda (A2) Nörd", "chiasso-brogeda-nord"),
        (T.detected_locale, "wie ist das und nicht hier", "de"),
        (T.detected_locale, "", "it"),
        (T.comma_list, " a, ,b ", ["a", "b"]),
        (T.closing_references, "Fixes #3, #4 and closes #5; see #6", [3, 4, 5]),
        (T.closing_references, "Chiude anche la issue #402, ferma con `agent:fix` e 6 run del fixer a vuoto.", [402]),
        (T.closing_references, "chiude #402", [402]),
        (T.closing_references, "Risolve #10", [10]),
        (T.closing_references, "Supera #20", [20]),
        (T.closing_references, "Chiude il problema descritto ma non tocca #402", []),
        (T.closing_references, "Il problema racchiude molte cose #402", []),
        (T.closing_references, "Closes #1, #2 and #3", [1, 2, 3]),
        (T.closing_references, "Closes #1 #2 #3", [1, 2, 3]),
        (T.closing_references, "Fixes #8 and touches #9", [8]),
        (T.closing_references, "Closes #1\nfixes #2\nRESOLVED: #3\nSupersedes #4", [1, 2, 3, 4]),
        (T.closing_references, "Vedi #402 per contesto", []),
        (T.entities_decoded, "\ue000 &amp;\uf8ff &amp;amp;nbsp;| & &bogus; &lt", "\ue000 &\uf8ff  | & &bogus; &lt"),
        (T.ts_unescaped, "\uf8ff \\\\n \\\\\\n \\", "\uf8ff \\n \\\n \\"),
        (lambda c: T.images_to_cdn(c, "https://cdn.example/", "https://www.example.org"), '<img src="/images/blog/a.webp" srcset="/images/blog/thumbnails/a.webp, https://www.example.org/images/blog/è.JPG.jpeg 2x">', '<img src="https://cdn.example/images/blog/a.webp" srcset="/images/blog/thumbnails/a.webp, https://cdn.example/images/blog/è.JPG.jpeg 2x">'),
        (lambda c: T.images_to_cdn(c, "https://cdn.example", "https://www.example.org"), "https://other.example/images/blog/a.webp /images/blog/a.pdf x@/images/blog/a.png https://raw.example/public/images/blog/b.png see /images/blog/b.png?v=1 url(/images/blog/c d.png)", "https://other.example/images/blog/a.webp /images/blog/a.pdf x@/images/blog/a.png https://raw.example/public/images/blog/b.png see https://cdn.example/images/blog/b.png?v=1 url(/images/blog/c d.png)"),
        (lambda c: T.image_value_to_cdn(c, "https://cdn.example", ("https://raw.example/public",)), "https://any.example/images/blog/a b.WEBP", "https://cdn.example/images/blog/a b.WEBP"),
        *[(lambda c: T.image_value_to_cdn(c, "https://cdn.example", ("https://raw.example/public",)), x, x) for x in ("see /images/blog/a.webp", "/images/blog/thumbnails/a.webp", "/images/blog/a.pdf", "https://cdn.example/images/blog/a.webp", "https://raw.example/public/images/blog/a.webp", "", "/images/blog/a.webp\n")],
        (T.stem, "lavorazione", "lavor"),
        (N.fnv1a32, "hello", 1335831723),
        (P.faq_heading, "Come fare", True),
        (P.faq_heading, "Comete", False),
        (P.articleable, "offerte lavoro ticino", False),
        (P.articleable, "lavoro frontaliere", True),
    ],
)
def test_text(spark, f, given, wanted):
    assert one(spark, f(F.col("x")), x=given) == wanted


def test_cuts(spark):
    assert one(spark, T.truncated_units(F.col("x"), 2), x="a😀b") == "a"
    assert one(spark, T.truncated_units(F.col("x"), 3), x="a😀b") == "a😀"
    for text in ("😀" * 40 + "ab", "a" + "😀" * 40, "ab😀", "\ue000é😀日本" * 9):
        raw = text.encode("utf-16-be")
        for most in (1, 2, 3, 7, 8, 80, 200):
            assert one(spark, T.truncated_units(F.col("x"), most), x=text) == raw[: 2 * most].decode("utf-16-be", "ignore")
    began = time.time()
    assert one(spark, F.char_length(T.truncated_units(F.col("x"), 79_999)), x="a" * 80_000 + "😀") == 79_999 and time.time() - began < 3
    assert one(spark, T.slug_truncated(F.col("x"), 10), x="uno-due-tre-quattro") == "uno-due-tr"
    assert one(spark, T.slug_truncated(F.col("x"), 11), x="uno-due-tre-quattro") == "uno-due-tre"
    assert one(spark, T.description_boosted(F.col("x"), "en", 2026, 60), x="A text") == "A text Updated for 2026."
    assert one(spark, T.description_boosted(F.col("x"), "en", 2026, 60), x="A text of 2025") == "A text of 2025"
    assert one(spark, T.heading_apart(F.col("x"), F.col("y"), "guida frontaliere", "Site"), x="A  b", y="a B | Site") == "A b (guida frontaliere)"


def test_terms(spark):
    r = one(spark, T.terms("x"), x="Nuovo accordo Banca Nazionale Svizzera")
    assert r["properNouns"] == ["banca", "nazionale", "svizzera", "banca nazionale svizzera"]
    assert r["bigrams"][0] == "nuovo accordo" and r["stems"][1] == "accord"
    assert T.terms_of("Città di Lugano, Centro. È l'Éra nuova Roma") == [
        ["citta", "lugano", "centro", "era", "nuova", "roma"], ["citta di", "di lugano", "lugano centro", "centro e", "era nuova", "nuova roma"],
        ["citta di lugano", "di lugano centro", "lugano centro e", "centro e l", "e l era", "l era nuova", "era nuova roma"], ["lugano", "centro", "e", "lugano centro e", "era", "roma"], ["citt", "lug", "centr", "era", "nuov", "rom"],
    ]
    assert T.terms_of(None) == T.terms_of(" .,") == [[]] * 5
    rows = [(i, t, "kept") for i, t in enumerate([None, "", "Una Prova Lunga", "b " * 200_000, "Ultima Riga"])]
    got = text_terms(spark.createDataFrame(rows, "id int, text string, `stems` string").withColumnRenamed("stems", "o.k")).collect()
    assert {r["id"]: [r[n] for n in T.TERMS] for r in got} == {i: T.terms_of(t) for i, t, _ in rows} and {r["o.k"] for r in got} == {"kept"}
    began = time.time()
    assert len(T.terms_of(" ".join(f"Word{i} and{i}" for i in range(8000)))[3]) == 7999 and time.time() - began < 0.5


def test_similarity(spark):
    a, b = (T.folded(T.similarity_tokens(F.lit(x))) for x in ("frontaliere lugano", "frontalieri in lugano"))
    assert one(spark, T.jaccard(a, b)) == 1.0


@pytest.mark.parametrize("slug, hours, wanted", [("nuovo-fisco", 2, True), ("hockey", 1, False), ("fisco", 72, False), ("fisco", -6, False), ("fisco", 48, True), ("fisco", None, True)])
def test_news(spark, slug, hours, wanted):
    now = datetime.datetime(2026, 1, 10)
    date = None if hours is None else (now - datetime.timedelta(hours=hours)).isoformat(sep=" ")
    none = F.lit(None).cast("string")
    e = P.news_eligible(F.lit(slug), none, none, none, F.lit(None).cast("array<string>"), F.lit(date).cast("string"), F.lit(now), ["fisco"])
    assert one(spark, e) is wanted


@pytest.mark.parametrize("source, imp, p50, age, trend, raw, final", [("orphan", 900.0, 400.0, 0.0, 0.0, 10, 10), ("suggest", 0.0, 100.0, 0.0, 0.0, 50, 30), ("news", 0.0, 100.0, 24.0, 0.0, 100, 80.5), ("trends", 0.0, 100.0, 0.0, 50.0, 50, 46), ("trends", 0.0, 100.0, 0.0, 10.0, 40, 36.8)])
def test_scores(spark, source, imp, p50, age, trend, raw, final):
    r = one(spark, N.discovery_score(F.lit(source), F.lit(imp), F.lit(90), F.lit(p50), F.lit(age), F.lit(trend), F.lit(True)))
    assert (r["rawScore"], round(r["finalScore"], 6)) == (raw, final)


def test_score_errors_and_slots(spark):
    r = one(spark, N.discovery_score(F.lit("x"), F.lit(1.0), F.lit(90), F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(True)))
    assert r["score_error"] == "unknown source" and r["finalScore"] is None
    got = spark.range(101).select(N.slot(F.col("id"), F.lit(80)).alias("s")).collect()
    assert [r["s"] for r in got] == ["proven"] * 80 + ["discovery"] * 20 + ["proven"]
    assert [one(spark, N.clamped_quota(F.lit(x))) for x in (59, 96)] == [60, 95]


def test_terms_joined_in_the_worker(spark):
    from lectern.operators.terms import joined_terms

    text = "Città di Lugano, Centro. È l'Éra nuova Roma 😀 \uff21bc Zeta zeta"
    df = spark.createDataFrame([(1, text), (2, None), (3, "Roma")], "id int, text string")
    names = ["stems", "trigrams", "properNouns"]
    own = {i: dict(zip(T.TERMS, T.terms_of(t), strict=True)) for i, t in ((1, text), (2, None), (3, "Roma"))}
    for alphabetical in (True, False):
        got = joined_terms(df, names=names, alphabetical=alphabetical)
        assert got.columns == ["id", *names]
        want = {i: ["|".join(sorted(x[n]) if alphabetical else x[n]) for n in names] for i, x in own.items()}
        assert {r["id"]: [r[n] for n in names] for r in got.collect()} == want
    lists = text_terms(df).select("id", *[F.array_join(F.array_sort(n), "|").alias(n) for n in names])
    assert lists.exceptAll(joined_terms(df, names=names)).count() == 0


def test_similar_sets_against_all_pairs(spark):
    import random

    random.seed(3)
    rows = [(i, random.sample("abcdefghij", random.randint(1, 6))) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    got = {(r["left_id"], r["right_id"]) for r in dedup.similar_sets(df, df, 0.6).collect()}
    want = {(i, j) for i, a in rows for j, b in rows if len({*a} & {*b}) / len({*a} | {*b}) >= 0.6}
    assert got == want


def test_issues(spark):
    df = spark.createDataFrame([(1, "statistiche", "vale 1,80"), (2, "Statistiche", "vale 1.80"), (3, "x", ""), (4, "x", None)], "id long, category string, claim string")
    got = dedup.merged_issues(df, T.claim_fingerprint(F.col("category"), F.col("claim"), F.col("id")), F.lit(1.0)).collect()
    assert sorted(r["n"] for r in got) == [1, 1, 2]


def test_canonical_and_feed(spark):
    a = spark.createDataFrame([("1", "s1", "T & t"), ("2", "s2", "x")], "id string, slug string, title string")
    o = spark.createDataFrame([("s1", "https://e.org/w/"), ("s2", "no")], "slug string, winner_url string")
    got = {r["id"]: (r["canonical"], r["winner_slug"]) for r in publish.canonical_urls(a, o, F.concat(F.lit("/"), "slug")).collect()}
    assert got == {"1": ("https://e.org/w/", "w"), "2": ("/s2", None)}
    assert 'isPermaLink="false">1<' in [r["xml"] for r in publish.feed_items(a, "https://e.org", "/p/").orderBy("id").collect()][0]
    with pytest.raises(ValueError):
        publish.shrink_guard(4, 9)


def test_usage_and_alerts(spark):
    m = spark.createDataFrame([(1, "m", 5, 0, 0, 1), (2, "result", 7, 1, 1, 1)], "ordinal int, type string, input_tokens int, cache_creation_input_tokens int, cache_read_input_tokens int, output_tokens int")
    assert audits.usage_totals(m).collect()[0][0] == 10 and audits.usage_totals(m.filter("ordinal = 1")).collect()[0][0] == 6
    a = spark.createDataFrame([("3",), ("0",), (None,), ("x",)], "n string")
    assert [r["alert"] for r in audits.shadow_alert(a, "n").collect()] == ["firing", "quiet", "unavailable", "unavailable"]


def test_bodies_and_images(spark, tmp_path):
    d = tmp_path / "s" / "it"
    d.mkdir(parents=True)
    (d / "a1.ts").write_text("export default {\n 'blog.article.a1.body1': 'uno\\nl\\'altro',\n 'blog.article.a1.body2': `due\nrighe`,\n 'blog.article.a1.faq': '[{\"q\":\"Q\",\"a\":\"A\"}]' };", encoding="utf-8")
    bodies = corpus.article_bodies(spark, str(tmp_path))
    got = {r["field"]: (r["section"], r["locale"], r["value"]) for r in bodies.collect()}
    assert got["body1"] == ("s", "it", "uno\nl'altro") and got["body2"][2] == "due\nrighe"
    assert [(r["q"], r["a"]) for r in corpus.faq_items(bodies).collect()] == [("Q", "A")]
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (3).to_bytes(4, "big") + (5).to_bytes(4, "big") + b"\0" * 8
    gif = b"GIF89a" + (7).to_bytes(2, "little") + (2).to_bytes(2, "little") + b"\0" * 4
    df = spark.createDataFrame([(png,), (gif,), (b"junk",), (None,)], "content binary")
    assert [(r["s"]["width"], r["s"]["height"]) for r in df.select(corpus.image_size("content").alias("s")).collect()] == [(3, 5), (7, 2), (None, None), (None, None)]


def test_orphans(spark):
    q = spark.createDataFrame([(1, " AVS "), (2, "avs"), (3, ""), (4, "cerco lavoro")], "ordinal int, query string").selectExpr("*", "'x' imp", "1 pos", "1 ctr", "1 clicks")
    assert [(r["headline"], r["imp"]) for r in corpus.orphan_candidates(q).collect()] == [("AVS", 0.0)]
