"""Column functions over text. Regular expressions are Java's; where word boundaries or white space
must not depend on the engine, classes are spelled out."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: White space as the web platform's regular expressions have it.
WS = r"[ \t\n\x0B\f\r\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
_WORD_START = r"(?<![A-Za-z0-9_])"

#: Question openings of FAQ headings.
FAQ_PREFIXES = [
    "Come", "Cosa", "Quando", "Quanto", "Dove", "Chi", "Perché", "Quale", "How", "What", "When", "Where", "Who", "Why", "Which", "Can", "Should", "Is", "Are", "Do", "Does",
    "Wie", "Was", "Wann", "Wo", "Wer", "Warum", "Welche", "Comment", "Quoi", "Quand", "Où", "Qui", "Pourquoi", "Quel", "Quelle", "Est-ce",
]
#: Entities and what they stand for.
ENTITIES = {
    "&amp;": "&", "&#038;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "’", "&#39;": "’", "&#039;": "’", "&nbsp;": " ",
    "&ldquo;": "“", "&rdquo;": "”", "&#8220;": "“", "&#8221;": "”", "&lsquo;": "‘", "&rsquo;": "’", "&#8216;": "‘", "&#8217;": "’",
    "&ndash;": "–", "&#8211;": "–", "&mdash;": "—", "&#8212;": "—", "&hellip;": "…", "&#8230;": "…",
}
#: Italian suffixes in the order in which they are tried.
SUFFIXES = [
    "amente", "azione", "azioni", "mento", "menti", "iamo", "ate", "ato", "ata", "ati", "ano", "are", "ere", "ire", "osi", "ose", "oso", "osa", "ico", "ica", "ici", "iche",
    "oni", "one", "i", "e", "a", "o",
]
#: Italian function words.
STOPWORDS = [
    "il", "la", "i", "le", "un", "una", "di", "da", "del", "della", "dello", "dei", "delle", "degli", "a", "al", "alla", "allo", "ai", "agli", "alle", "in", "nel", "nella",
    "nello", "nei", "nelle", "negli", "con", "su", "sul", "sulla", "sullo", "sui", "sulle", "sugli", "per", "tra", "fra", "e", "o", "che", "non",
]
#: Words too common in the domain to tell two headlines apart.
DOMAIN_STOPLIST = [
    "frontaliere", "svizzera", "italia", "ticino", "lavoro", "permesso", "imposta", "pensione", "cambio", "costo", "frontalier", "svizzer", "italian", "lavor", "tic",
    "nuovo", "nuovi", "nuova", "nuove", "ticinese", "ticinesi",
]
#: Words that mark a language.
MARKERS = {
    "en": r"how|what|when|where|why|anyone|does|is|are|can|should|would|could|i'?m|i\s*am|i've|i\s*have|the|and|with|for|from|about|please|thanks|thank\s*you|guys|friends|guy|girl|years\s*old|cheap|good|best|some|any",
    "de": r"wie|was|wann|wo|warum|wieso|ich|du|sie|er|nicht|ja|nein|oder|und|aber|mit|für|von|zu|aus|haben|hat|hatte|sind|ist|war|werden|möchte|kann|soll|braucht|brauche|frage|hilfe|kennen|kenne|weiss|weiß|jemand|leute",
    "fr": r"comment|quoi|quand|où|pourquoi|qui|combien|je|tu|il|elle|nous|vous|ils|elles|le|la|les|un|une|des|et|ou|mais|avec|pour|sans|dans|sur|aux|mon|ma|mes|ton|ta|tes|son|sa|ses|c'est|j'ai|merci|s'il|svp",
    "it": r"come|quando|dove|perch[ée]|chi|cosa|quanto|qualcuno|consiglio|consigli|aiuto|domanda|sono|ho|hai|fa|si|no|e|o|ma|con|per|senza|in|su|del|della|delle|dei|degli|gli|grazie|prego|conoscete|sapete|secondo",
}
_STOPPED = frozenset(STOPWORDS)
_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def replaced(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    return c


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def squashed(c: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return trimmed(F.regexp_replace(c, f"{WS}+", " "))


def markdown_to_plain(c: Column) -> Column:
    """bold, italic, links, headings, bullets, numbers, code, line ends and spaces, in this order."""
    return trimmed(replaced(
        c, (r"\*\*([^*\n]+)\*\*", "$1"), (r"\*([^*\n]+)\*", "$1"), (r"\[([^\]]+)\]\([^)]+\)", "$1"), (rf"(?m)^#{{1,6}}{WS}+", ""), (rf"(?m)^[-*+]{WS}+", ""),
        (rf"(?m)^\d+\.{WS}+", ""), (r"`([^`]+)`", "$1"), (r"\n{2,}", " "), (r"\n", " "), (f"{WS}{{2,}}", " "),
    ))


def literal_markdown_removed(c: Column) -> Column:
    """F02, for titles."""
    return trimmed(replaced(c, (r"\*\*([^*\n]+?)\*\*", "$1"), (r"\*{2,}", ""), (r"[_=~]{3,}", " "), (rf"^{WS}*\*+{WS}*", ""), (rf"{WS}*\*+{WS}*$", ""), (r"[ \t]{2,}", " ")))


def entities_decoded(c: Column) -> Column:
    """up to three single passes. Within a pass what an entity yields is not read again: the text is
    cut at its entities, each piece is looked up by itself, and the pieces are joined."""
    known = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    names = "|".join(e[1:-1] for e in ENTITIES)

    def one_pass(x: Column) -> Column:
        pieces = F.split(x, f"(?=&(?:{names});)|(?<=&(?:{names});)")
        return F.when(x.contains("&"), F.array_join(F.transform(pieces, lambda p: F.when(F.startswith(p, F.lit("&")), F.coalesce(F.try_element_at(known, p), p)).otherwise(p)), "")).otherwise(x)

    for _ in range(3):
        c = one_pass(c)
    return c


def html_to_text(c: Column) -> Column:
    """tags go, a fixed list of entities is decoded in order, other named ones become spaces."""
    steps = [("&amp;", "&"), ("&quot;", '"'), ("&apos;", "'"), ("&#8217;", "'"), ("&#8216;", "'"), ("&#8220;", '"'), ("&#8221;", '"'), ("&#8211;", "–"), ("&#8212;", "—"), ("&nbsp;", " ")]
    c = F.regexp_replace(c, "<[^>]+>", "")
    for a, b in steps:
        c = F.replace(c, F.lit(a), F.lit(b))
    return squashed(F.regexp_replace(c, "(?i)&[a-z]+;", " "))


def scripts_removed(c: Column) -> Column:
    """F05."""
    return replaced(c, (r"(?is)<script\b[^>]*>.*?</script>", ""), (r"(?is)<style\b[^>]*>.*?</style>", ""))


def meta_tags(c: Column) -> Column:
    """og: and description meta tags, one a line."""
    tags = F.regexp_extract_all(c, F.lit(r"(?is)(<meta\b[^>]*>)"), F.lit(1))
    return F.array_join(F.filter(tags, lambda t: t.rlike(r"(?i)(property|name)=[\"'](og:[^\"']+|description)[\"']")), "\n")


def ts_unescaped(c: Column, newline: str = "\n") -> Column:
    """one pass over backslash escapes; unknown ones stay. The text is cut at escaped backslashes,
    so that what follows one isn't taken for an escape."""
    steps = (("\\'", "'"), ('\\"', '"'), ("\\n", newline), ("\\r", ""), ("\\t", " "))

    def unescaped(x: Column) -> Column:
        for a, b in steps:
            x = F.replace(x, F.lit(a), F.lit(b))
        return x

    return F.array_join(F.transform(F.split(c, r"\\\\"), unescaped), "\\")


def meta_unescaped(c: Column) -> Column:
    """one pass over escaped quotes and backslashes; every other escape stays."""
    whole = F.transform(F.split(c, r"\\\\"), lambda x: F.regexp_replace(x, r"\\(['\"])", "$1"))
    return F.array_join(whole, "\\")


def double_breaks_repaired(c: Column, by: str = "\n") -> Column:
    """F10."""
    return F.regexp_replace(c, r"\\+n", by)


def xml_escaped(c: Column) -> Column:
    """null gives an empty string; apostrophes stay."""
    c = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def script_json(c: Column) -> Column:
    """JSON that may stand in a script element."""
    return F.replace(c, F.lit("<"), F.lit("\\u003c"))


def truncated_units(c: Column, most: int) -> Column:
    """at most so many UTF-16 units, no surrogate pair being split; null stays null. Texts without
    characters beyond the basic plane, nearly all, are cut by characters; others by the bytes of their
    units, of which the last one goes if it is the first half of a pair."""
    units = F.substring(F.encode(c, "UTF-16BE"), 1, 2 * most)
    halved = F.hex(F.substring(units, 2 * most - 1, 1)).between("D8", "DB")
    whole = F.when(halved, F.substring(units, 1, 2 * most - 2)).otherwise(units)
    return F.when(c.rlike(r"[\x{10000}-\x{10FFFF}]"), F.decode(whole, "UTF-16BE")).otherwise(F.substring(c, 1, most))


def jsonld_description(c: Column, most: int = 5000) -> Column:
    """trimmed, cut, empty becomes null."""
    return F.nullif(truncated_units(trimmed(c), most), F.lit(""))


def slug_truncated(c: Column, most: int) -> Column:
    """F16: cut at a word end; a dash counts if it is in the last quarter."""
    cut = F.substring(c, 1, most)
    dash = F.when(F.contains(cut, F.lit("-")), F.char_length(cut) - F.locate("-", F.reverse(cut))).otherwise(-1)
    at_edge = F.substring(c, most + 1, 1).isin("-", "")
    return F.when(c.isNull(), "").when(F.char_length(c) <= most, c).when(at_edge, cut).when(dash >= most * 0.75, F.left(cut, dash)).otherwise(cut)


@F.pandas_udf(StringType())
def marks_stripped(s: pd.Series) -> pd.Series:
    """decomposed, without combining marks."""
    return s.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.category(c).startswith("M")))


@F.pandas_udf(StringType())
def compatible(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not "\u0300" <= c <= "\u036f"))


def crossing_slug(c: Column, overrides: dict[str, str] | None = None) -> Column:
    """F17."""
    plain = F.lower(replaced(compatible(c), (r"\([^)]*\)", ""), (r"[^a-zA-Z0-9]+", "-"), (r"-+", "-"), (r"^-|-$", "")))
    for name, slug in (overrides or {"Widnau-Lustenau (Schmitterbrücke)": "widnau-lustenau-schmitterbrucke"}).items():
        plain = F.when(c == name, slug).otherwise(plain)
    return plain


#: What a heading equal to its title gets, by locale; others get the first.
HEADING_TAGS = {"it": "guida frontaliere", "en": "cross-border guide", "de": "Grenzgänger-Leitfaden", "fr": "guide frontalier"}


def heading_tag(locale: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in HEADING_TAGS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.coalesce(locale, F.lit(""))), F.lit(HEADING_TAGS["it"]))


def heading_apart(h1: Column, title: Column, tag: Column | str, brand: str) -> Column:
    """a heading equal to the title (brand suffix apart) gets a tag."""
    h, t = squashed(F.coalesce(h1, F.lit(""))), squashed(F.coalesce(title, F.lit("")))
    t = trimmed(F.regexp_replace(t, rf"(?i){WS}*[|·]{WS}*{brand}{WS}*$", ""))
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.when((h == "") | (t == "") | (F.lower(h) != F.lower(t)), h).otherwise(F.concat(h, F.lit(" ("), tag, F.lit(")")))


#: What a description gets, by locale.
YEAR_SUFFIX = {"it": " Aggiornato %d.", "en": " Updated for %d.", "de": " Aktualisiert %d.", "fr": " Mis à jour %d."}


def description_boosted(c: Column, locale: str, year: int, most: int) -> Column:
    """F19."""
    suffix = YEAR_SUFFIX[locale] % year
    keep = (c == "") | c.rlike(rf"{_EDGE}20\d{{2}}{_EDGE}") | (F.char_length(c) + len(suffix) > most)
    return F.when(keep, c).otherwise(F.concat(c, F.lit(suffix)))


def publisher_host(url: Column) -> Column:
    """the host, lower-cased, without www.; null where there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", ""), F.lit(""))


def similarity_tokens(c: Column) -> Column:
    """F23."""
    return F.filter(F.regexp_extract_all(marks_stripped(F.lower(F.coalesce(c, F.lit("")))), F.lit("([a-z0-9]+)"), F.lit(1)), lambda t: F.char_length(t) >= 3)


def folded(tokens: Column) -> Column:
    """distinct six-letter openings."""
    return F.array_distinct(F.transform(tokens, lambda t: F.substring(t, 1, 6)))


def jaccard(a: Column, b: Column) -> Column:
    """F25, over sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def tokens_of(c: Column) -> Column:
    """tokens as they stand."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), rf"(?:{WS}|[\p{{P}}\p{{S}}])+"), lambda t: t != "")


def stem(c: Column) -> Column:
    """the first suffix in the list that leaves three letters goes."""
    out = None
    for s in SUFFIXES:
        fits = F.endswith(c, F.lit(s)) & (F.char_length(c) - len(s) >= 3)
        cut = F.left(c, F.char_length(c) - len(s))
        out = F.when(fits, cut) if out is None else out.when(fits, cut)
    return F.when(F.char_length(c) < 4, c).otherwise(out.otherwise(c))


_BETWEEN = regex.compile(rf"(?:{WS}|[\p{{P}}\p{{S}}])+")
TERMS = ["unigrams", "bigrams", "trigrams", "properNouns", "stems"]


class _Known(dict):
    """What a function gives for each token, asked once; emptied when it has grown large."""

    def __init__(self, of, most: int = 300_000):
        self.of, self.most = of, most

    def __missing__(self, token: str):
        if len(self) >= self.most:
            self.clear()
        value = self[token] = self.of(token)
        return value


def _plain_token(t: str) -> str:
    return t.lower() if t.isascii() else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.category(c).startswith("M")).lower()


def _stemmed(t: str) -> str:
    return t if len(t) < 4 else next((t[: -len(s)] for s in SUFFIXES if len(t) - len(s) >= 3 and t.endswith(s)), t)


_plain, _stem_of = _Known(_plain_token), _Known(_stemmed)
_capital = _Known(lambda t: unicodedata.category(t[0]) == "Lu")
_counts = _Known(lambda t: len(t) >= 3 and t not in _STOPPED)


def _phrases(raw: list[str], normal: list[str]) -> Iterator[str]:
    """Capitalised tokens after the first one, and each run of two or more as a phrase when it ends."""
    at = [i for i, capital in enumerate(map(_capital.__getitem__, raw)) if capital and i]
    start = 0
    for k, i in enumerate(at, 1):
        yield normal[i]
        if k == len(at) or at[k] != i + 1:
            if k - start > 1:
                yield " ".join(normal[at[start] : i + 1])
            start = k


def _grams(normal: list[str], n: int) -> Iterator[str]:
    return (g for g in map(" ".join, zip(*[normal[k:] for k in range(n)], strict=False)) if len(g) >= 6)


def terms_of(text: str | None, names: list[str] = TERMS) -> list[list[str]]:
    """The lists of ``terms`` for one text, or those of ``names`` alone, in one pass over its tokens."""
    raw = [t for t in _BETWEEN.split(text or "") if t]
    normal = list(map(_plain.__getitem__, raw))
    uni = dict.fromkeys(filter(_counts.__getitem__, normal))
    of = {"unigrams": lambda: uni, "bigrams": lambda: _grams(normal, 2), "trigrams": lambda: _grams(normal, 3), "properNouns": lambda: _phrases(raw, normal), "stems": lambda: map(_stem_of.__getitem__, uni)}
    return [list(dict.fromkeys(of[n]())) for n in names]


@F.pandas_udf(StructType([StructField(n, ArrayType(StringType())) for n in TERMS]))
def terms(c: pd.Series) -> pd.DataFrame:
    """unigrams, bigrams, trigrams, properNouns and stems, each distinct and in the order of the text. A text is gone
    through once, in a Python worker: lists that grow inside an expression are copied at each step. For headlines; whole
    texts are better given to ``operators.terms.text_terms``, which holds less at once."""
    return pd.DataFrame([terms_of(t) for t in c], columns=TERMS)


def by_first_letter(markers: str) -> str:
    """The same alternatives under their first letters, so that a place is tried against few of them;
    those of one letter keep their order, and others never start at one place."""
    groups: dict[str, list[str]] = {}
    for m in markers.split("|"):
        groups.setdefault(m[0], []).append(m[1:])
    return f"(?=[{''.join(groups)}]){_WORD_START}({'|'.join(f'{k}(?:{"|".join(v)})' for k, v in groups.items())}){_EDGE}"


def marker_count(c: Column, locale: str) -> Column:
    """Distinct markers of a language, with ASCII word edges, in a text in lower case."""
    return F.size(F.array_distinct(F.regexp_extract_all(c, F.lit(by_first_letter(MARKERS[locale])), F.lit(1))))


def detected_locale(c: Column) -> Column:
    """two markers at least and no language with more; en, de, fr in this order, else it."""

    def pick(n):
        most = F.greatest(*[n[k] for k in MARKERS])
        first = F.when((n["en"] >= 2) & (n["en"] == most), "en").when((n["de"] >= 2) & (n["de"] == most), "de")
        return first.when((n["fr"] >= 2) & (n["fr"] == most), "fr").otherwise("it")

    def counted(lower):
        return F.struct(*[marker_count(lower, k).alias(k) for k in MARKERS])

    # each step is bound once, as the next uses it several times
    return F.get(F.transform(F.transform(F.array(F.lower(F.coalesce(c, F.lit("")))), counted), pick), 0)


def word_count(c: Column) -> Column:
    """tags off, then words between spaces."""
    return F.size(F.filter(F.split(F.regexp_replace(c, "<[^>]+>", " "), r"\s+"), lambda w: w != ""))


def filename_words(c: Column) -> Column:
    """F34."""
    stem_ = F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]+$", "")
    return F.filter(F.split(F.lower(stem_), "[^a-z0-9]+"), lambda w: F.char_length(w) >= 4)


def claim_fingerprint(category: Column, claim: Column, row_id: Column) -> Column:
    """a number, else three tokens, else an opening; empty claims never share one."""
    cat, raw = F.lower(F.coalesce(F.nullif(category, F.lit("")), F.lit("?"))), F.lower(F.coalesce(claim, F.lit("")))
    number = F.replace(F.regexp_extract(raw, r"(\d+[.,]\d+|\d+)", 1), F.lit(","), F.lit("."))
    tokens = distinctive(similarity_tokens(raw))
    words = F.array_join(F.array_sort(F.slice(tokens, 1, 3)), "-")
    return F.when(raw == "", F.concat_ws(":", cat, F.lit("empty"), row_id.cast("string"))).when(number != "", F.concat_ws(":", cat, F.lit("num"), number)).when(F.size(tokens) >= 2, F.concat_ws(":", cat, F.lit("words"), words)).otherwise(F.concat_ws(":", cat, F.lit("raw"), F.regexp_replace(F.substring(raw, 1, 60), f"{WS}+", " ")))


def distinctive(tokens: Column) -> Column:
    """Duplicates stay."""
    return F.filter(tokens, lambda t: ~t.isin(DOMAIN_STOPLIST))


def comma_list(c: Column) -> Column:
    """F39."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), trimmed), lambda x: x != "")


def closing_references(c: Column) -> Column:
    """issue numbers after a closing verb, runs of several included. Between an Italian verb and the
    number bridge words may stand, no others."""
    verbs = r"close[sd]?|fix(?:e[sd])?|resolve[sd]?|supersede[sd]?|chiude|chiuso|risolve|risolto|supera"
    runs = F.regexp_extract_all(F.lower(c), F.lit(rf"{_WORD_START}(?:{verbs})\s*:?\s+(?:(?:anche|la|le|issue)\s+)*(#\d+(?:\s*(?:,|and{_EDGE}|e{_EDGE})?\s*#\d+)*)"), F.lit(1))
    return F.array_distinct(F.transform(F.flatten(F.transform(runs, lambda r: F.regexp_extract_all(r, F.lit(r"#(\d+)"), F.lit(1)))), lambda n: n.cast("int")))


#: The types of files that stand on the CDN.
CDN_TYPES = r"\.(?:webp|png|jpe?g|avif)"


def images_to_cdn(html: Column, cdn: str, origin: str, folder: str = "/images/blog/") -> Column:
    """references of a page to images directly in the folder, by the site's own address or without one, go
    to the CDN. Thumbnails, other types, other hosts and what follows a letter, digit, _, . or @ stay, and so
    does what was rewritten before."""
    name, by = rf"([^\"'/?)\s\x0B\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]+?{CDN_TYPES})", f"{cdn.rstrip('/')}{folder}$1"
    return replaced(html, (rf"\Q{origin.rstrip('/')}{folder}\E{name}", by), (rf"(?<![A-Za-z0-9_.@])\Q{folder}\E{name}", by))


def image_value_to_cdn(c: Column, cdn: str, served: tuple[str, ...] = (), folder: str = "/images/blog/") -> Column:
    """a value that is as a whole the reference of an image directly in the folder, of any host, goes to the
    CDN; null becomes empty, every other value stays, so do those that begin with the CDN's or another of the
    ``served`` addresses."""
    to = cdn.rstrip("/") + folder
    file = F.regexp_extract(c, rf"(?i)^(?:https?://[^/]+)?{folder}([^/]+{CDN_TYPES})\z", 1)
    there = F.lit(False)
    for address in (to.rstrip("/"), *served):
        there = there | F.startswith(c, F.lit(address))
    return F.when(c.isNull(), "").when(there | (file == ""), c).otherwise(F.concat(F.lit(to), file))
