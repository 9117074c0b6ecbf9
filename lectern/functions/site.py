"""Column functions for publishing and for the upkeep of a corpus: anchors, links, pages, verdicts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.predicates import first_match
from lectern.functions.text import WS, meta_tags, scripts_removed, squashed, trimmed, truncated_units

#: Topics of news by theme. The site's own name is the caller's to add.
NEWS_TOPICS = [
    "fisco", "fiscale", "tasse", "tassa", "730", "dichiarazione", "irpef", "nuovo-accordo-2026", "nuovo accordo", "accordo-fiscale", "imposta-fonte", "imposta alla fonte",
    "valore-locativo", "valore locativo", "perequazione", "ristorni",
    "avs", "lpp", "pensione", "pensioni", "previdenza", "pilastro-3a", "terzo pilastro",
    "lamal", "assicurazione-malattia", "assicurazione malattia", "cassa-malati", "cassa malati", "cmi", "tassa-salute", "tassa salute",
    "dogana", "frontiera", "varco", "permit-g", "permit g", "permesso g", "permit-b", "permit b", "permesso b", "lavoro-frontaliere", "lavoro frontaliere",
    "parita-frontalieri", "parita frontalieri", "ristorni-frontalieri", "ristorni frontalieri", "salari", "salario", "stipendi", "stipendio", "contratto",
    "dumping-salariale", "dumping salariale", "frontalieri-ticino", "frontalieri del ticino", "lavoratori-frontalieri", "lavoratori frontalieri", "disoccupazione",
    "occupazione-ticino", "occupazione ticino", "mercato-lavoro", "mercato del lavoro",
    "cambio-valuta", "cambio valuta", "chf-eur", "chf eur", "franco-svizzero", "franco svizzero", "franco forte", "bonifico", "tasso", "tassi-bce", "tassi bce",
    "inflazione", "bce-tassi", "bce tassi",
    "trasporti-frontaliere", "trasporti frontaliere", "treno", "tilo", "traffico", "webcam-dogana", "webcam dogana", "autisti-bus", "autisti bus", "a2-melide", "a2 melide",
    "a2-chiasso", "a2 chiasso", "pendolarismo", "autostrada-a2", "autostrada a2", "ffs-ticino", "ffs ticino", "treni-svizzeri", "treni svizzeri", "ferrovia-ticino",
]
#: Phrases that tie a text to cross-border work, in the order in which they are tried.
STRICT_ANCHORS = [
    r"\bfrontalier", r"\btransfrontalier", r"\bpendolar[ie]\b", r"\bcross[- ]border\b", r"\bgrenzg[äa]nger", r"\bpermess[oi]\s+[bgcdl]\b", r"\bristorn[oi]\b", r"\bimposta\s+alla\s+fonte\b",
    r"\bdoppia\s+imposizion", r"\baccordo\s+(?:fiscale|bilaterale)\s+(?:italia[- ]svizzera|ch[- ]it|cra)", r"\bnuovo\s+accordo\s+fiscale", r"\b(?:tassa|imposta)\s+salute\b", r"\b(?:lamal|cassa\s+malati)\b",
    r"\b(?:avs|ahv)\b", r"\blpp\b", r"\b(?:secondo|terzo)\s+pilastro\b", r"\bbusta\s+paga\s+svizzer", r"\bstipendi[oi]\s+svizzer", r"\bnetto\s+svizzer",
    r"\bvalico\s+(?:di\s+)?(?:brogeda|gaggiolo|ponte\s+tresa|chiasso|stabio)", r"\bdogana\s+(?:di\s+)?(?:chiasso|brogeda|gaggiolo|ponte\s+tresa|stabio)", r"\btelelavoro\s+frontalier",
    r"\bmercato\s+del\s+lavoro\s+ticines", r"\baziende?\s+che\s+assumon[oa]\s+frontalier", r"\bcambio\s+(?:chf|franco|eur)", r"\beur\s*\/\s*chf|chf\s*\/\s*eur", r"\btotalizzazione\s+(?:dei\s+)?contributi\b",
    r"\bquadro\s+ce\b", r"\binps\b.{0,60}\b(?:frontalier|svizzer|avs|ahv)\b", r"\b(?:frontalier|svizzer|avs|ahv)\b.{0,60}\binps\b", r"\bagenzia\s+(?:delle\s+)?entrate\b.{0,60}\bfrontalier",
    r"\bfrontalier.{0,60}\bagenzia\s+(?:delle\s+)?entrate\b",
]
#: Those of them that mean nothing else, in their own order.
UNAMBIGUOUS_ANCHORS = [
    r"\bristorn[oi]\b", r"\bimposta\s+alla\s+fonte\b", r"\bdoppia\s+imposizion", r"\baccordo\s+(?:fiscale|bilaterale)\s+(?:italia[- ]svizzera|ch[- ]it|cra)", r"\bnuovo\s+accordo\s+fiscale",
    r"\b(?:tassa|imposta)\s+salute\b", r"\b(?:lamal|cassa\s+malati)\b", r"\b(?:avs|ahv)\b", r"\blpp\b", r"\b(?:secondo|terzo)\s+pilastro\b", r"\bbusta\s+paga\s+svizzer", r"\bstipendi[oi]\s+svizzer",
    r"\bnetto\s+svizzer", r"\bpermess[oi]\s+[bgcdl]\b", r"\btelelavoro\s+frontalier", r"\bmercato\s+del\s+lavoro\s+ticines", r"\baziende?\s+che\s+assumon[oa]\s+frontalier", r"\beur\s*\/\s*chf|chf\s*\/\s*eur",
    r"\binps\b.{0,60}\b(?:frontalier|svizzer|avs|ahv)\b", r"\b(?:frontalier|svizzer|avs|ahv)\b.{0,60}\binps\b", r"\bagenzia\s+(?:delle\s+)?entrate\b.{0,60}\bfrontalier",
    r"\bfrontalier.{0,60}\bagenzia\s+(?:delle\s+)?entrate\b",
]
#: Openings of words of the domain.
DOMAIN_TERMS = r"frontal|grenzg|permess(o|i)\s*[gbl]|tass[ae]|fisco|fiscal|imposta|irpef|quellensteuer|busta\s*paga|salar|stipend|salaire|gehalt|cassa\s*malati|lamal|cmi|assicur|krankenkass|pension|avs|ahv|lpp|bvg|terzo\s*pilastro|secondo\s*pilastro|pilastro\s*3[ab]|(?:pillar|pilier)\s*3[ab]|cambio|chf|euro|valut|telelavoro|smart\s*working|t[ée]l[ée]travail|homeoffic|pendolar|commut|dogana|valico|frontiera|bordo|bord[ée]r|naspi|disoccupaz|ristorn|accordo|abkommen|bilateral|svizzer|switzer|tessin|ticin|lombard|comask|varesin|grigion|grauen|mutu|hypothek|prestit|banc|conto\s*corrente|cas[ae]|abita|alloggi|immobil|appartament|affitt|locazion|wohnung|comprare|acquistare|vendere|kaufen|acheter|italia|italien|italie|familia|familiar|figli[oa]?|kinder|enfants|children|residen|domicil|wohnsitz"
#: How someone says that a finding is a false positive; after a negation it doesn't count.
_NOT = r"(?<!(?<![A-Za-z0-9_])non\s{1,9}(?:è|sono|erano)\s{1,9}(?:un\s{1,9}|una\s{1,9})?)(?<!(?<![A-Za-z0-9_])not\s{1,9}(?:a\s{1,9})?)"
FALSE_POSITIVE = rf"{_NOT}falso positivo|{_NOT}false positive|{_NOT}solo lessicalmente simil\w*|lessicalmente simil\w*(?:[^.]{{0,40}})semanticamente divers\w*|{_NOT}semanticamente divers\w*|non è (?:lo stesso|la stessa) (?:anti-?pattern|costrutto|classe)|not the same (?:anti-?pattern|construct|bug class)"
#: File types and the shape of hashed names.
ASSET_TYPES = "js|mjs|css|woff2?|ttf|otf|eot|png|jpe?g|webp|avif|gif|svg|ico|json"
HASHED_NAME = r"^(.+)-([A-Za-z0-9_-]{8})\.(js|css)$"


#: What a match of any anchor holds, one or another, in lower case.
_ROOTS = [
    "frontalier", "pendolar", "border", "grenzg", "permess", "ristorn", "imposta", "imposizion", "accordo", "salute", "lamal", "malati", "avs", "ahv", "lpp", "pilastro",
    "svizzer", "valico", "dogana", "ticines", "cambio", "chf", "contributi", "quadro",
]


def _plain_edges(pattern: str) -> str:
    """Word edges and white space that don't depend on the engine; in all these patterns an edge is
    the start of a word if a letter or group follows, else its end."""
    starts = re.sub(r"\\b(?=[A-Za-z(])", "(?<![A-Za-z0-9_])", pattern)
    return starts.replace(r"\b", "(?![A-Za-z0-9_])").replace(r"\s", WS)


def anchor(c: Column, unambiguous: bool = False) -> Column:
    """What the first anchor that matches has matched, else null. Texts without any root are
    not searched by pattern."""
    low = F.lower(c)
    found = first_match(c, [_plain_edges(p) for p in (UNAMBIGUOUS_ANCHORS if unambiguous else STRICT_ANCHORS)])
    return F.when(reduce(lambda a, b: a | b, [F.contains(low, F.lit(r)) for r in _ROOTS]), found)


def domain_term(c: Column) -> Column:
    """P05; null is false."""
    return F.coalesce(c.rlike("(?iu)(?<![A-Za-z0-9_])(?:" + _plain_edges(DOMAIN_TERMS) + ")"), F.lit(False))


def declared_false_positive(c: Column) -> Column:
    """P16."""
    return F.coalesce(c.rlike(f"(?iu){FALSE_POSITIVE}"), F.lit(False))


def image_leak(html: Column, origin: str, folder: str = "/images/blog/") -> Column:
    """An image that is still served by the site itself; thumbnails may be."""
    own = origin.replace(".", r"\.")
    return html.rlike(rf"(?:{own}{folder}|(?<![\w.@]){folder})(?!thumbnails/)[^\"'\s/?)]+?\.(?:webp|png|jpe?g|avif)")


def same_origin_asset(html: Column) -> Column:
    """P10."""
    return html.rlike(rf"[\"'(]/?assets/[^\"'() ]*\.(?:{ASSET_TYPES})")


def hashed_name(c: Column) -> Column:
    """(name, hash, type) of a hashed file name, else null."""
    part = lambda i: F.regexp_extract(c, HASHED_NAME, i)
    return F.when(c.rlike(HASHED_NAME), F.struct(part(1).alias("name"), part(2).alias("hash"), part(3).alias("type")))


def sweepable(state: Column, draft: Column, number: Column) -> Column:
    """Open, no draft, with a number."""
    return F.coalesce((F.upper(state) == "OPEN") & ~F.coalesce(draft, F.lit(False)) & F.try_to_number(number.cast("string"), F.lit("999999999")).isNotNull(), F.lit(False))


def canonical_login(c: Column) -> Column:
    """app/x and x[bot] are x."""
    return F.regexp_replace(F.regexp_replace(trimmed(c), "^app/", ""), r"\[bot\]$", "")


def by_author(login: Column, authors: list[str]) -> Column:
    """Whether a login, in its canonical form, is one of ``authors``; null is none."""
    return F.coalesce(canonical_login(login).isin(authors), F.lit(False))


def headlines(html: Column, least: int = 20, prefix: str = "maggiori informazioni su") -> Column:
    """(href, headline) of each link; a screen-reader prefix goes, and what is left must have
    ``least`` characters."""
    link = r"""<a\b[^>]*?href=["']([^"']*)["'][^>]*>(.*?)</a>"""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(f"(?is)({link})"), F.lit(1))

    def of(a: Column) -> Column:
        text = squashed(F.regexp_replace(F.regexp_extract(a, f"(?is){link}", 2), "<[^>]+>", " "))
        return F.struct(F.regexp_extract(a, f"(?is){link}", 1).alias("href"), trimmed(F.regexp_replace(text, rf"(?iu)^{prefix}\s*:?\s*", "")).alias("headline"))

    return F.filter(F.transform(links, of), lambda s: F.char_length(s["headline"]) >= least)


def evidence_sentence(source: Column, value: Column, percent: bool = False) -> Column:
    """the first sentence that holds the value literally; in percentages a comma is a dot. Null if none."""
    plain = (lambda c: F.replace(c, F.lit(","), F.lit("."))) if percent else (lambda c: c)
    return F.get(F.filter(F.split(source, r"(?<=[.!?])\s+"), lambda s: F.contains(plain(s), plain(value))), 0)


def issue_class(title: Column, labels: Column) -> Column:
    """(category, route, fuPrio, autofix). Labels backlog and crawler-transient win over any title
    and route nowhere; publish failures alone skip the queue; patterns beyond those cases are this engine's own."""
    t = F.lower(F.coalesce(title, F.lit("")))
    has = lambda x: F.coalesce(F.array_contains(labels, x), F.lit(False))
    named = F.when(t.rlike(r"fast-publish|generate blog|journalist"), "generation").when(t.rlike(r"publish[- ]api|publish article data"), "publish").when(t.rlike(r"\bengine\b"), "engine").otherwise("other")
    category, still = F.when(has("backlog"), "backlog").otherwise(named), has("backlog") | has("crawler-transient")
    route = F.when(still, "none").when(category == "publish", "fix").otherwise("queue")
    prio = F.when(route == "queue", F.when(has("priority:high") | (category == "engine"), "high").when(category == "generation", "low").otherwise("normal"))
    return F.struct(category.alias("category"), route.alias("route"), prio.alias("fuPrio"), F.lit(True).alias("autofix"))


def drift_class(mode: Column, site: Column, own: Column, base_site: Column, base_own: Column, tracking: Column) -> Column:
    """(state, actionable, detail) of a file kept in two places, by hashes now and at the baseline."""
    site_moved, own_moved = ~site.eqNullSafe(base_site), ~own.eqNullSafe(base_own)
    pending, here_only = mode == "corpus-only-pending", mode == "corpus-only"
    moved = F.when(own.isNull(), "missing-here").when(site_moved & own_moved, "both-moved").when(site_moved, "site-ahead").when(own_moved, "corpus-ahead").otherwise("stable")
    state = F.when(here_only, "corpus-only").when(pending & site.isNull(), "corpus-only-pending").when(pending, "corpus-only-pending-landed").otherwise(moved)
    detail = F.when(pending & site.isNotNull(), "to be made identical or adapted").when(pending, F.coalesce(tracking, F.lit("ATTENZIONE: no tracking issue")))
    return F.struct(state.alias("state"), (~state.isin("corpus-only", "stable")).alias("actionable"), detail.alias("detail"))


def provenance(baseline: Column, current: Column, in_history: Column, exhausted: Column) -> Column:
    """current, history, ghost (in no version of a history that was searched whole), unresolved, or
    unchecked where there's no baseline or no search."""
    return F.when(baseline.isNull(), "unchecked").when(baseline == current, "current").when(in_history.isNull(), "unchecked").when(in_history, "history").when(F.coalesce(exhausted, F.lit(False)), "ghost").otherwise("unresolved")


def stranded_days(mode: Column, state: Column, seen: Column, now: Column) -> Column:
    """Days since an identical twin's baseline was seen while the site is ahead, else null."""
    age = (F.unix_micros(now) - F.unix_micros(F.try_to_timestamp(seen))) / 8.64e10
    return F.when((mode == "identical") & (state == "site-ahead") & (age >= 0), age)


def stranded(days: Column, threshold: float = 3) -> Column:
    return F.coalesce(days >= threshold, F.lit(False))


def turn_budget(n: Column) -> Column:
    """A14."""
    return F.least(F.lit(240), 26 + 8 * n)


def tab_markers(c: Column) -> Column:
    """tabs, real or escaped, that a digit follows."""
    return F.regexp_count(c, F.lit(r"\t[0-9]|\\+t[0-9]"))


def day_stamp(now: Column) -> Column:
    """F55, in a session whose zone is UTC."""
    return F.concat(F.date_format(now, "yyyy-MM-dd"), F.lit("T00:00:00.000Z"))


def dedup_text(title: Column, excerpt: Column, most: int = 4000) -> Column:
    """F32."""
    return truncated_units(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(excerpt, F.lit(""))), most)


def hub_path(locale: Column, index_slug: Column, all_slug: Column) -> Column:
    """Italian paths have no prefix."""
    return F.concat(F.when(locale == "it", "").otherwise(F.concat(F.lit("/"), locale)), F.lit("/"), index_slug, F.lit("/"), all_slug, F.lit("/"))


def contribution_digest(c: Column) -> Column:
    """F62."""
    return F.coalesce(F.sha2(c, 256), F.lit("NULL"))


def bridge_page(sibling: Column, url: Column) -> Column:
    """A page that leads on to ``url``, titled and tagged as its sibling."""
    found = F.nullif(trimmed(F.regexp_extract(scripts_removed(F.coalesce(sibling, F.lit(""))), r"(?i)<title[^>]*>([^<]+)</title>", 1)), F.lit(""))
    title, tags = F.coalesce(found, F.concat(F.lit("Redirecting to "), url)), meta_tags(F.coalesce(sibling, F.lit("")))
    quoted = F.concat(F.lit('"'), F.replace(F.replace(url, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    lines = [
        F.lit("<!DOCTYPE html>"), F.lit('<html lang="it">'), F.lit("<head>"), F.lit('<meta charset="utf-8">'), F.concat(F.lit("<title>"), title, F.lit("</title>")),
        F.concat(F.lit('<link rel="canonical" href="'), url, F.lit('">')), F.lit('<meta name="robots" content="noindex,follow">'), F.nullif(tags, F.lit("")),
        F.concat(F.lit("<script>location.replace("), quoted, F.lit(" + window.location.search + window.location.hash)</script>")), F.lit("</head>"),
        F.concat(F.lit("<body><h1>"), title, F.lit('</h1><a href="'), url, F.lit('">Continua su '), url, F.lit("</a></body>")), F.lit("</html>"),
    ]
    return F.concat_ws("\n", *lines)


#: What pages tell crawlers, and the names of a build's files.
ROBOTS_INDEX = "index, follow, max-snippet:-1, max-image-preview:large, max-video-preview:-1"
CRITICAL_CSS, ENTRY_JS, ENTRY_CSS = "critical.css", "index-entry.js", "index.css"


def image_object(content_url: Column, owner: str, owner_url: str, license_page: str, year: int, creator: Column | None = None, first_year: int = 2024, **more: Column) -> Column:
    """JSON of an image with its license; absent fields are left out, an absent URL is an error."""
    years = str(first_year) if year <= first_year else f"{first_year}–{year}"
    name = F.coalesce(creator, F.lit(owner)) if creator is not None else F.lit(owner)
    who = F.struct(F.lit("Organization").alias("@type"), name.alias("name"), F.when(name == owner, F.lit(owner_url)).alias("url"))
    url = F.coalesce(F.nullif(content_url, F.lit("")), F.raise_error(F.lit("an image needs an URL")))
    fixed = {"@type": F.lit("ImageObject"), "contentUrl": url, "url": url, "acquireLicensePage": F.lit(license_page), "copyrightNotice": F.lit(f"© {years} {owner}. Tutti i diritti riservati."), "license": F.lit(license_page), "creator": who, "creditText": name}
    return F.to_json(F.struct(*[c.alias(k) for k, c in (fixed | more).items()]))
