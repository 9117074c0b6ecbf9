import datetime

import pytest
from pyspark.sql import functions as F

from lectern.functions import numeric as N
from lectern.functions import site as S
from lectern.operators import audits, upkeep
from lectern.sources import corpus



def now():
    return F.lit(datetime.datetime(2026, 8, 14, 6))


def of(spark, column, **values):
    return spark.createDataFrame([tuple(values.values()) or (0,)], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items()) or "x int").select(column.alias("r")).collect()[0]["r"]


@pytest.mark.parametrize(
    "f, given, wanted",
    [
        (S.anchor, "Il Permesso G e la LAMal", "Permesso G"), (S.anchor, "un permessog", None), (S.domain_term, "le Tasse", True), (S.domain_term, "nulla", False),
        (S.declared_false_positive, "È un falso positivo", True), (S.declared_false_positive, "non è un falso positivo", False), (S.declared_false_positive, "this is not a false positive", False),
        (S.same_origin_asset, '<a href="/assets/a.js">', True), (S.same_origin_asset, '"https://c/assets/a.js"', False), (S.hashed_name, "main-AbCd_-12.js", ("main", "AbCd_-12", "js")), (S.hashed_name, "main.js", None),
        (S.canonical_login, "app/some-bot", "some-bot"), (S.canonical_login, "x[bot]", "x"), (S.tab_markers, "a\t1 \\\\t2", 2), (S.contribution_digest, None, "NULL"),
    ],
)
def test_functions(spark, f, given, wanted):
    assert of(spark, f(F.col("x")), x=given) == wanted


def test_image_leak(spark):
    leak = lambda x: of(spark, S.image_leak(F.col("x"), "https://e.org"), x=x)
    assert leak('src="/images/blog/a.webp"') and leak("https://e.org/images/blog/a.png")
    assert not leak('"/images/blog/thumbnails/a.webp"') and not leak("https://cdn.e.org/images/blog/a.webp")


@pytest.mark.parametrize(
    "inner, wanted",
    [
        ('<span class="sr-only">Maggiori informazioni su</span> Il Consiglio approva il nuovo accordo', "Il Consiglio approva il nuovo accordo"), ("MAGGIORI INFORMAZIONI SU:  <b>Nuove misure per il mercato</b>", "Nuove misure per il mercato"),
        ("Il portale con maggiori informazioni su pensioni", "Il portale con maggiori informazioni su pensioni"), ("Maggiori informazioni su: Sciopero", None),
    ],
)
def test_headlines(spark, inner, wanted):
    got = of(spark, S.headlines(F.col("x")), x=f'<a href="/n/1">{inner}</a>')
    assert [(g["href"], g["headline"]) for g in got] == ([("/n/1", wanted)] if wanted else [])


def test_evidence(spark):
    text = "Altro. Il tasso applicato e del 1,2,3% secondo la fonte."
    assert of(spark, S.evidence_sentence(F.col("x"), F.lit("1.2.3"), True), x=text) == "Il tasso applicato e del 1,2,3% secondo la fonte."
    assert of(spark, S.evidence_sentence(F.col("x"), F.lit("C++ F")), x="Il gruppo C++ F c'è.") == "Il gruppo C++ F c'è." and of(spark, S.evidence_sentence(F.col("x"), F.lit("z")), x="a") is None


@pytest.mark.parametrize(
    "title, labels, wanted",
    [
        ("Workflow Failure: Publish article data API", ["Bug"], ("publish", "fix", None)), ("Workflow Failure: publish-api", [], ("publish", "fix", None)), ("Workflow Failure: fast-publish-article", [], ("generation", "queue", "low")),
        ("Workflow Failure: Publish Journalist Articles", [], ("generation", "queue", "low")), ("Workflow Failure: engine lockstep drift", [], ("engine", "queue", "high")), ("x", ["priority:high"], ("other", "queue", "high")),
        ("Workflow Failure: engine lockstep drift", ["backlog"], ("backlog", "none", None)), ("Workflow Failure: Publish article data API", ["crawler-transient"], ("publish", "none", None)),
    ],
)
def test_issues(spark, title, labels, wanted):
    r = of(spark, S.issue_class(F.col("t"), F.col("l")), t=title, l=labels)
    assert (r["category"], r["route"], r["fuPrio"]) == wanted and r["autofix"]


def test_verdicts(spark):
    drift = lambda *v: tuple(of(spark, S.drift_class(*[F.lit(x).cast("string") for x in v])))
    assert drift("corpus-only", None, "a", None, None, None)[:2] == ("corpus-only", False)
    assert drift("corpus-only-pending", None, "a", None, None, "#5")[:3] == ("corpus-only-pending", True, "#5")
    assert drift("corpus-only-pending", "b", "a", None, None, "#5")[:2] == ("corpus-only-pending-landed", True)
    assert drift("identical", "b", "a", "a", "a", None)[0] == "site-ahead" and drift("identical", "a", "a", "a", "a", None)[:2] == ("stable", False)
    ghost = lambda b, c, h, e: of(spark, S.provenance(F.lit(b).cast("string"), F.lit(c), F.lit(h).cast("boolean"), F.lit(e).cast("boolean")))
    assert [ghost(None, "a", None, None), ghost("a", "a", None, None), ghost("o", "n", True, True), ghost("o", "n", False, True), ghost("o", "n", False, False), ghost("o", "n", None, None)] == ["unchecked", "current", "history", "ghost", "unresolved", "unchecked"]
    days = lambda m, s, t: of(spark, S.stranded(S.stranded_days(F.lit(m), F.lit(s), F.col("x"), now())), x=t)
    assert [days("identical", "site-ahead", t) for t in ("2026-08-11 06:00:00", "2026-08-12 06:00:00", None, "x", "2026-08-20 06:00:00")] == [True, False, False, False, False]
    assert not days("adapted", "site-ahead", "2026-01-01") and of(spark, S.turn_budget(F.lit(40))) == 240


def test_pages_and_images(spark):
    page = of(spark, S.bridge_page(F.col("x"), F.lit("/a/")), x='<script><title>no</title></script><title> T </title><meta property="og:title" content="T">')
    assert "<title>T</title>" in page and '\n<meta property="og:title" content="T">\n<script>location.replace("/a/")'.replace('"/a/")', '"/a/" +') in page
    assert "Redirecting to /a/" in of(spark, S.bridge_page(F.col("x"), F.lit("/a/")), x=None)
    image = of(spark, S.image_object(F.col("x"), "Site", "https://e.org/", "/l", 2026, width=F.lit(3), caption=F.lit(None).cast("string")), x="/i.png")
    assert '"copyrightNotice":"© 2024–2026 Site. Tutti i diritti riservati."' in image and '"width":3' in image and "caption" not in image
    assert of(spark, S.hub_path(F.lit("de"), F.lit("a"), F.lit("alle"))) == "/de/a/alle/"
    avif = b"\0\0\0\x1cftypavif" + b"\0" * 8 + b"ispe" + b"\0" * 4 + (9).to_bytes(4, "big") + (4).to_bytes(4, "big")
    assert tuple(spark.createDataFrame([(avif,)], "content binary").select(corpus.image_size("content").alias("s")).collect()[0]["s"]) == (9, 4)


def test_logs_and_states(spark):
    u = '{"type":"m","message":{"usage":{"input_tokens":2,"output_tokens":3}}}'
    r = '{"type":"result","usage":{"input_tokens":7,"output_tokens":1}}'
    for text, total in ((f"[{u},{r}]", 8), (f'{{"messages":[{u},{u}]}}', 10), (u, 5), (f"{u}\nbad\n{r}", 8), ("", 0)):
        got = upkeep.log_messages(spark.createDataFrame([(text,)], "value string"))
        assert audits.usage_totals(got).collect()[0][0] == total, text
    got = upkeep.quota_states(spark.createDataFrame([('{"runCounter":-3,"currentQuota":99}',), ("bad",)], "value string")).collect()
    assert [tuple(g) for g in got] == [(1, 0, 95, None), (1, 0, 80, None)]


def test_tables(spark):
    posts = spark.createDataFrame([("h", "<b>Una notizia lunga</b>", "u", "2026-08-10T00:00:00"), ("h", "corta", "u", "2026-08-10"), ("h", "Una notizia vecchia", "u", "2026-08-01"), ("h", "Una notizia senza data", "u", "x"), (None, None, None, None)], "host string, title string, link string, date string")
    assert [r["headline"] for r in upkeep.post_headlines(posts, now()).collect()] == ["Una notizia lunga"]
    files = spark.createDataFrame([("/a/lugano-lago.webp",), ("/a/x1.webp",), ("/a/roma.png",), ("/a/como.webp",)], "path string")
    assert [tuple(r) for r in upkeep.catalog_entries(files, files.filter("path like '%como%'")).collect()] == [("/a/lugano-lago.webp", ["lugano", "lago"])]
    dates = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("1/2",)], "date string")
    got = upkeep.repairs(dates, spark.createDataFrame([("b-2026-01-01",)], "id string"), F.concat(F.lit("b-"), "date"))
    assert {r["date"]: r["verdict"] for r in got.collect()} == {"2026-01-01": "ok", "2026-01-02": "not registered", "1/2": "bad date"}
    names = spark.createDataFrame([("a.js",), ("a-12345678.js",), ("b-12345678.js",)], "file string")
    got = upkeep.first_candidates(names, spark.createDataFrame([("a",), ("b",), ("c",)], "name string"))
    assert {r["name"]: r["file"] for r in got.collect()} == {"a": "a.js", "b": "b-12345678.js", "c": None}
    names = ["vendor-carousel.js", "vendor-AB12.js", "app-AB12.js", "app-zz.js.map", "x-1.js", "x-0.js", "y.js", "y-1.js", "w-.js", "v-a.b.js", "a.b-c_d-e.js"]
    listed = spark.createDataFrame(list(enumerate(names)), "i int, file string")
    got = upkeep.first_candidates(listed, spark.createDataFrame([(x,) for x in ("vendor-carousel", "vendor", "app", "x", "y", "w", "v", "a.b", "z")], "name string"), "i")
    assert {r["name"]: r["file"] for r in got.collect()} == {"vendor-carousel": "vendor-carousel.js", "vendor": "vendor-carousel.js", "app": "app-AB12.js", "x": "x-1.js", "y": "y.js", "w": None, "v": None, "a.b": "a.b-c_d-e.js", "z": None}
    hubs = upkeep.hub_slugs(spark.createDataFrame([("s", {"it": "a", "en": "b"})], "section string, index_slugs map<string,string>"))
    assert {r["slug"]: r["locale"] for r in hubs.collect()} == {"a": "it", "b": "en"}


@pytest.mark.parametrize("date, hours, minutes", [("2026-08-14 05:00:00", 1.0, 60), ("2026-08-15 05:00:00", 0.0, 0), (None, 48.0, None), ("x", 48.0, None)])
def test_ages(spark, date, hours, minutes):
    assert of(spark, N.age_hours(F.col("x"), now()), x=date) == hours
    assert of(spark, N.minutes_since(F.col("x"), now()), x=date) == minutes


def test_medians_against_sorted_values(spark):
    import random

    from lectern.operators.publish import group_medians

    drawn = random.Random(3)
    rows = [(k, drawn.choice([1.5, 2.25, -7.0, drawn.uniform(-9, 9)])) for k in ("a", "b", None) for _ in range(301 if k else 40)]
    rows += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("same", 3.0), ("same", 3.0), ("same", 3.0), ("none", None), ("a", None)]
    values = {}
    for k, v in rows:
        if v is not None:
            values.setdefault(k, []).append(v)
    want = {k: 0.5 * sorted(v)[(len(v) - 1) // 2] + 0.5 * sorted(v)[len(v) // 2] for k, v in values.items()}
    df = spark.createDataFrame(rows, "cluster string, price double")
    for parts in (1, 5, 40):  # partitions of the rows; ranges are as many as the session's shuffle has
        assert {r["cluster"]: r["p50"] for r in group_medians(df.repartition(parts), "cluster", "price").collect()} == want
    assert group_medians(df.limit(0), "cluster", "price").collect() == []
