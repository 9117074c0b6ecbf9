"""Secret scans: keyed patterns, and windows of high Shannon entropy over candidate strings.

A candidate is a maximal run of characters that keys are written in. For each character class a
window slides over the candidate's stretches in that class; the counts of its characters, and with
them the entropy, change by the one that enters and the one that leaves. Windows above the class's
threshold that mix kinds of characters are joined to spans. Candidates that the allow-list knows
are left out.
"""

from __future__ import annotations

import re
from math import log2
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import replacing, set_aside

#: The keyed patterns in the order in which kinds are listed, with the least length that counts.
BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
ENTROPY = "entropy"
KINDS = [*BASE, ENTROPY]
CANDIDATE = r"[A-Za-z0-9+/_=-]"


class WindowRule(NamedTuple):
    """A class of characters, the width of its window, the bits of entropy from which a window counts,
    and the least numbers of digits, capitals and small letters in it."""

    characters: str
    width: int
    bits: float
    digits: int
    capitals: int
    small: int


#: Capital hex and mixed hex, base 32, base 36 and base 64. A window of 20 random base-64 characters has 4.1 bits on average.
RULES = (
    WindowRule("[0-9A-Fa-f]", 24, 3.0, 3, 0, 0),
    WindowRule("[A-Z0-9]", 20, 3.5, 3, 3, 0),
    WindowRule("[a-z0-9]", 24, 3.6, 4, 0, 4),
    WindowRule(CANDIDATE, 20, 3.8, 2, 2, 2),
)

#: What may stand in clean texts: a pattern on the candidate, or on the 24 characters before it and the candidate. The mark \x00 stands between the two.
ALLOW = (
    r"\x00[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"\x00[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9T+/_-]*$",  # dates and times
    r"\x00[0-9+/_=-]*$",  # no letters
    r"\x00[A-Za-z+/_=-]*$",  # no digits
    r"(?i:commit|revision|blob|tree|sha-?1|sha-?256|sha-?512|md5|checksum|digest|etag)[\"']?[ ]?[:= ][ ]?[\"']?\x00",  # digests of public things
    r"(?i:https?://|www\.)[^\s]*\x00",  # inside an address
    r"\x00(?i:[0-9a-z+/_=-]*(?:example|sample|dummy|placeholder|changeme|xxxx)[0-9a-z+/_=-]*)$",
    r"\x00(?:[A-Z][a-z]+|[a-z]{3,}|(?<=[/_-])[A-Za-z]{1,2}(?=[/_-])|(?<=[A-Za-z/_-])[0-9]{1,4}(?![0-9])|[/_-])+$",  # words in a path or an identifier
    r"\x00(?i:[a-z]*(?:0123456789|1234567890|abcdefghijklmnop)[0-9a-z+/_=-]*)$",  # alphabets
)

_SCALE = 1 << 20


def hot_spans(text: str, rule: WindowRule) -> list[tuple[int, int]]:
    """The unions of the rule's windows in a stretch of its class. With c(x) the count of x in a window
    of w, entropy is log2(w) - sum c log2 c / w; the sum changes by two terms at each step, and is
    kept in whole numbers, so that it doesn't drift."""
    width = rule.width
    if len(text) < width:
        return []
    term = [round(c * log2(c) * _SCALE) if c else 0 for c in range(width + 1)]
    most = (log2(width) - rule.bits) * width * _SCALE
    raw = text.encode("ascii")
    counts, total, kinds, found = [0] * 128, 0, [0, 0, 0, 0], []
    kind_of = [0 if 48 <= x <= 57 else 1 if 65 <= x <= 90 else 2 if 97 <= x <= 122 else 3 for x in range(128)]
    for i, x in enumerate(raw):
        c = counts[x]
        total += term[c + 1] - term[c]
        counts[x] = c + 1
        kinds[kind_of[x]] += 1
        if i >= width:
            y = raw[i - width]
            c = counts[y]
            total += term[c - 1] - term[c]
            counts[y] = c - 1
            kinds[kind_of[y]] -= 1
        if i >= width - 1 and total <= most and kinds[0] >= rule.digits and kinds[1] >= rule.capitals and kinds[2] >= rule.small and kinds[1] + kinds[2]:
            start = i + 1 - width
            if found and start <= found[-1][1]:
                found[-1][1] = i + 1
            else:
                found.append([start, i + 1])
    return [(a, z) for a, z in found]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


class Scanner:
    """The patterns of one scan, compiled once for each task."""

    def __init__(self, rules: tuple[WindowRule, ...], allow: tuple[str, ...]):
        # ASCII: either case of A-Z alone, not the signs that fold to them.
        self.base = {k: (re.compile(p, re.ASCII | (re.IGNORECASE if k == "assign" else 0)), group, least) for k, (p, group, least) in BASE.items()}
        self.base["hex"] = (re.compile(f"[0-9a-f]{{{BASE['hex'][2]},}}"), 0, 0)  # the same runs, found without looking at shorter ones
        self.rules = [(re.compile(f"{r.characters}{{{r.width},}}"), r) for r in rules]
        self.candidate = re.compile(f"{CANDIDATE}{{{min((r.width for r in rules), default=1)},}}")
        self.allow = re.compile("|".join(f"(?:{a})" for a in allow)) if allow else None

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then kind as listed."""
        found = [(k, m.start(), m.end()) for k, (p, group, least) in self.base.items() for m in p.finditer(text) if m.end(group) - m.start(group) >= least]
        hot = []
        for c in self.candidate.finditer(text):
            # The mark can't be forged: a text's own \x00 before a candidate is taken out of what is looked at.
            if self.allow and self.allow.search(text[max(0, c.start() - 24) : c.start()].replace("\x00", " ") + "\x00" + c.group()):
                continue
            for pattern, rule in self.rules:
                for m in pattern.finditer(c.group()):
                    hot += [(c.start() + m.start() + a, c.start() + m.start() + z) for a, z in hot_spans(m.group(), rule)]
        inside = united([(a, z) for _, a, z in found])
        found += [(ENTROPY, a, z) for a, z in united(hot) if not any(b <= a and z <= y for b, y in inside)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(docs: DataFrame, rules: tuple[WindowRule, ...] = RULES, allow: tuple[str, ...] = ALLOW, text: str = "text") -> DataFrame:
    """Secrets in whole texts: the keyed patterns' matches (leftmost, not overlapping within a kind), and
    as kind ``entropy`` the unions of high-entropy windows that no keyed match holds whole.

    ``allow`` suppresses entropy spans alone, never keyed ones. Null and empty texts have no spans,
    equal rows get equal results, an empty table gives an empty one; ids play no part, so any may be null
    or repeated. One pass, each text within its own task; nothing is exchanged, so a lost
    executor costs its tasks alone. Returns the columns of ``docs`` but the text (columns named as the new
    ones are replaced, any other name is kept), and n_assign, n_access, n_hex, n_entropy (long), and
    spans array<struct<kind, start, end>> in code points, the end exclusive.
    """
    new = [f"n_{k}" for k in KINDS] + ["spans"]
    inner, back = set_aside(replacing(docs, *[n for n in new if n != text]), text)
    likely = rf"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{{{BASE['hex'][2]}}}|{CANDIDATE}{{{min((r.width for r in rules), default=1000)}}}"
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    held: list[Scanner] = []

    def run(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Scanner(rules, allow))
        # A linear-time pass leaves the texts that hold anything at all.
        worth = pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(texts, likely), False)).to_pylist()
        out: list[list] = [[]] * len(texts)
        for i in worth:
            out[i] = [dict(zip(("kind", "start", "end"), s, strict=True)) for s in held[0].spans(texts[i].as_py())]
        return pa.array(out, pa.list_(kind))

    scan = F.arrow_udf(run, "array<struct<kind:string,start:bigint,end:bigint>>")
    done = docs.select(*inner, scan(F.col(f"`{text}`")).alias("spans"))
    return done.select(*back, *[count_of(F.col("spans"), k).alias(f"n_{k}") for k in KINDS], "spans")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(list(BASE)))
