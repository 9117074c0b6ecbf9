"""Quality rules: statistics of single texts, and line frequency across the documents of a host."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import ASCII_SPACE, materialise, replacing, set_aside

SYMBOLS = "#*$%&|<>"
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def line_hash(line: str) -> int:
    """The hash of a normalised line, signed; 0 if it has no word."""
    key = line.strip(ASCII_SPACE).encode().lower()
    return np.uint64(xxhash.xxh64_intdigest(key)).astype(np.int64).item() if key else 0


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated 3-word windows)."""
    words = text.encode().split()
    chars = len(text) - sum(text.count(c) for c in ASCII_SPACE)
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, n in Counter(windows).items() if n > 1}
        covered = np.zeros(len(words) + 2, bool)
        at = np.flatnonzero(np.fromiter((w in often for w in windows), bool, len(windows)))
        for k in range(3):
            covered[at + k] = True
        repeated = int(covered.sum())
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated


def line_table(text: str) -> tuple[list[int], list[int]]:
    """Of the distinct normalised lines with a word: hashes, and the words that each takes up in the text."""
    words: dict[int, int] = {}
    for line in text.split("\n"):
        if h := line_hash(line):
            words[h] = words.get(h, 0) + len(line.encode().split())
    return list(words), list(words.values())


def lines_above(lines: DataFrame, line_limit: int) -> DataFrame:
    """(h, line): the lines that more than ``line_limit`` distinct documents of a host hold, of ``lines``
    (h, line, mark). ``mark`` names a text by its hash: copies are one document. Both steps are summed
    in the map tasks first, so a host or line of any size is dealt evenly."""
    return lines.select("h", "line", "mark").distinct().groupBy("h", "line").count().filter(F.col("count") > line_limit).select("h", "line")


def _judged(docs: DataFrame, inner: list[Column], min_words: int, max_repeat_percent: int, line_limit: int, min_left: float, text: str, host: str, with_gone: bool) -> DataFrame:
    """``inner`` columns of ``docs`` (names c0, c1, ... and t), statistics and verdicts. One pass over the
    texts makes statistics and line hashes, written to the shared folder; the rest are joins of hashes."""

    def read(texts: pd.Series) -> pd.DataFrame:
        texts = [t or "" for t in texts]
        out = pd.DataFrame([statistics(t) for t in texts], columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
        lines = [line_table(t) for t in texts]
        out["mark"] = [np.uint64(xxhash.xxh64_intdigest(t.encode())).astype(np.int64).item() for t in texts]
        for k, name in enumerate(("line", "words")):
            out[name] = pd.Series([x[k] for x in lines], dtype=object)
        return out

    read_all = F.pandas_udf(read, f"{_STATS}, mark long, line array<long>, words array<long>")
    own = docs.select(*inner, F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("\x00null")).alias("h"), read_all(F.col(f"`{text}`")).alias("x"))
    stats = materialise(own.withColumn("row", F.monotonically_increasing_id()).select("row", *[c for c in own.columns if c != "x"], "x.*"), "quality")
    lines = stats.select("row", "h", "mark", F.explode(F.arrays_zip("line", "words")).alias("x")).select("row", "h", "mark", "x.*")
    above = materialise(lines_above(lines, line_limit), "quality-above")
    gone = [F.collect_list("line").alias("gone")] if with_gone else []
    removed = lines.select("row", "h", "line", "words").join(above, ["h", "line"]).groupBy("row").agg(F.sum("words").alias("removed"), *gone)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    out = F.coalesce("removed", F.lit(0))
    depleted = (out > 0) & (F.col("n_words") - out < min_left * F.col("n_words"))
    both = stats.drop("line", "words", "mark", "h").join(removed, "row", "left")
    return both.withColumns({"base_failed": failed, "n_words_removed": out, "kept": ~failed & ~depleted})


def quality_rules(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, line_limit: int = 20, min_left: float = 0.3, with_text: bool = False, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Base rules for each text, then removal of lines that too many documents of a host share.

    A document fails the base rules with fewer than ``min_words`` words or more than
    ``max_repeat_percent`` percent of them in repeated 3-word windows. A line (ASCII white space
    stripped, A-Z lower-cased, by 64-bit hash) is above the limit in a host if more than
    ``line_limit`` distinct documents there hold it; documents with equal texts are one. A document is
    depleted if the lines not above limits hold less than ``min_left`` of its words; it is rejected.

    Null texts are empty, null hosts are one host. A row is a document, so ids may be null or
    repeat; equal rows get equal results, and an empty table gives an empty one. Returns the columns of
    ``docs`` but the text (names below are replaced, any other is kept) and ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``n_words_removed``, ``kept``, and with ``with_text`` also ``text`` without the lines above
    limits. Texts are read once and move only with ``with_text``.
    """
    new = [*[c.split()[0] for c in _STATS.split(", ")], "base_failed", "n_words_removed", "kept"]
    base = replacing(docs, *[n for n in new if n not in (text, host)])
    inner, back = set_aside(base, text)
    judged = _judged(base, [*inner, *[F.col(f"`{text}`").alias("t")] * with_text], min_words, max_repeat_percent, line_limit, min_left, text, host, with_text)
    cut = [without_lines()(F.col("t"), F.col("gone")).alias(text)] if with_text else []
    return judged.select(*back, *new, *cut)


def quality_filter(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The documents that ``quality_rules`` keeps, whole and with all their columns, whatever their names.

    Rows are judged one by one: null texts are empty and fail, equal rows stay or go together, ids play no
    part, and an empty table gives an empty one. The texts are read once and stand in the judged table, which
    is filtered where it is read; what remains to be joined is the sums of removed words."""
    inner, back = set_aside(docs, t=text)
    return _judged(docs, inner, 50, 50, 20, 0.3, text, host, False).filter("kept").select(*back)


def without_lines():
    def cut(texts: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for t, g in zip(texts, gone, strict=True):
            drop = set() if g is None else set(g)
            out.append(t if not drop or t is None else "\n".join(x for x in t.split("\n") if line_hash(x) not in drop))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(cut, "string")
