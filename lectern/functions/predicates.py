"""Boolean column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import _EDGE, FAQ_PREFIXES, similarity_tokens, trimmed

#: Intents of a search.
JOB_SEARCH = r"cerco|cercare|offert[ae]|annunci?|posti?|lavoro|jobs?|assunzioni|curriculum|cv"
ARTICLE = r"frontalier[aeio]|permesso\s*g|tass|impost|fisc|stipendio|salario|busta\s*paga|avs|lpp|lamal|cmi|ristorni|telelavoro|smart\s*working|disoccupazione|naspi|dichiarazione|credito\s+d.?imposta"
#: How a reviewer says that the source lacks something.
ABSENCE = r"(non\s+(?:è\s+)?(?:menzion\w+|present\w+|riport\w+|cit\w+|indic\w+|compare|contien\w+|specific\w+|sostien\w+|conferm\w+))|(?:assente|mancante)\s+(?:dalla|nella)\s+fonte"
#: Scripts other than the Latin one.
OTHER_SCRIPTS = r"[Ѐ-ԯ԰-֏֐-׿؀-ۿ　-〿぀-ゟ゠-ヿ㐀-䶿一-鿿가-힯]"


def news_eligible(slug: Column, title: Column, section: Column, keywords: Column, tags: Column, published: Column, now: Column, words: list[str], window_hours: int = 48) -> Column:
    """A topic word is in the fields, and the date, if any, parses, is past and within the window."""
    age = F.unix_micros(now) - F.unix_micros(F.try_to_timestamp(published))
    in_time = F.coalesce((age >= 0) & (age <= window_hours * 3_600_000_000), F.lit(False))
    hay = F.lower(F.concat_ws("  ", *[F.coalesce(c, F.lit("")) for c in (slug, title, section, keywords)], F.coalesce(tags, F.array().cast("array<string>"))))
    topic = F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(hay, w))
    return (published.isNull() | in_time) & topic


def first_match(c: Column, patterns: list[str]) -> Column:
    """What the first pattern that matches has matched, else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, f"(?iu){p}", 0), F.lit("")) for p in patterns])


def articleable(c: Column) -> Column:
    """P06."""
    q = trimmed(F.coalesce(c, F.lit("")))
    hit = lambda p: q.rlike(f"(?iu){_EDGE}({p}){_EDGE}")
    return (q != "") & ~(hit(JOB_SEARCH) & ~hit(ARTICLE))


def faq_heading(c: Column) -> Column:
    """P07."""
    openings = "|".join(p.replace("-", r"\-") for p in FAQ_PREFIXES)
    return F.contains(c, F.lit("?")) | c.rlike(rf"^(?:{openings})(?![A-Za-zÀ-ÿ])")


def other_script_ratio(c: Column) -> Column:
    """P08."""
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    return F.when(F.coalesce(letters, F.lit(0)) == 0, 0.0).otherwise(F.regexp_count(c, F.lit(OTHER_SCRIPTS)) / letters)


def other_script(c: Column, threshold: float = 0.1) -> Column:
    """More than ``threshold`` of the letters are of another script than the Latin one."""
    return other_script_ratio(c) > threshold


def contradicted_by_source(claim: Column, reason: Column, source: Column, support: float = 0.7) -> Column:
    """The reviewer says that it's absent, yet most of the claim's tokens stand in the source."""
    both = F.array(F.struct(similarity_tokens(claim).alias("claim"), similarity_tokens(source).alias("source")))  # bound once, outside the lambdas
    held = F.get(F.transform(both, lambda b: (F.size(b["claim"]) >= 4) & (F.size(F.filter(b["claim"], lambda t: F.array_contains(b["source"], t))) >= support * F.size(b["claim"]))), 0)
    return (F.char_length(source) >= 100) & F.coalesce(reason, F.lit("")).rlike(f"(?iu){ABSENCE}") & held


def parked_draft(is_draft: Column, updated: Column, labels: Column, now: Column) -> Column:
    """P20: a draft for over 48 hours that waits for nobody."""
    age = (F.unix_micros(now) - F.unix_micros(F.try_to_timestamp(updated))) / 3.6e9
    return F.coalesce(is_draft & (age > 48) & ~F.array_contains(labels, "needs-human"), F.lit(False))


def under_path(path: Column, folders: list[str], files: list[str]) -> Column:
    """P21."""
    out = path.isin(files)
    for f in folders:
        out = out | F.startswith(path, F.lit(f.rstrip("/") + "/"))
    return out


def retryable(status: Column) -> Column:
    """P23."""
    return (status == 429) | status.between(500, 599)


def backoff_ms(attempt: Column) -> Column:
    return 1000 * F.pow(F.lit(2), attempt - 1)


def thin(words: Column, least: int = 300) -> Column:
    """A04."""
    return words < least


