"""Boilerplate of several lines, by distinct documents of a host, against a plain version."""

import random
import re

import pytest
from pyspark.sql import Row

from lectern.llm.quality import quality_filter, quality_rules

SCHEMA = "doc_id long, text string, source string"


def line(name, n):
    return " ".join(f"{name}w{i}" for i in range(n))


def near_copies(first, n, head=()):
    """Copies of a page of six lines of 20 words, each with one or two words changed."""
    rng, out = random.Random(first), []
    for i in range(n):
        words = [line(f"page{first}l{k}", 20).split() for k in range(6)]
        for _ in range(rng.randint(1, 2)):
            words[rng.randrange(6)][rng.randrange(20)] = f"changed{first + i}x{rng.random()}"
        out.append((first + i, "\n".join([*head, *map(" ".join, words)]), "h"))
    return out


def judged(spark, data):
    return {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(data, SCHEMA)).collect()}


@pytest.mark.parametrize("shared", [1, 2, 3])
def test_pages_under_several_long_shared_lines_go(spark, shared):
    boiler = [line(f"boiler{k}", 80) for k in range(shared)]
    got = judged(spark, [(i, "\n".join([*boiler, line(f"own{i}", 10)]), "h") for i in range(60)])
    assert {(r["n_words_removed"], r["kept"]) for r in got.values()} == {(80 * shared, False)}


def plain_rules(data, limit=20, min_words=50, most=50, left=0.3):
    """Every column of quality_rules but the text, in plain Python."""
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    words = lambda x: re.findall(r"[^\x20\x09-\x0D]+", x)
    holders = {}
    for _, text, host in data:
        for x in (text or "").split("\n"):
            holders.setdefault((host, key(x)), set()).add(text or "")
    out = []
    for id, text, host in data:
        t = text or ""
        w, seen, dup = words(t), set(), 0
        for x in t.split("\n"):
            dup += bool(words(x)) and x in seen
            seen.add(x)
        at = {}
        for i in range(len(w) - 2):
            at.setdefault(tuple(w[i : i + 3]), []).append(i)
        repeated = len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)})
        gone = sum(len(words(x)) for x in t.split("\n") if key(x) and len(holders[(host, key(x))]) > limit)
        failed = len(w) < min_words or 100 * repeated > most * len(w)
        out.append((id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, repeated, failed, gone, not failed and not (gone and len(w) - gone < left * len(w))))
    return out


def test_every_column_against_a_plain_version(spark):
    rng = random.Random(9)
    nav, foot = line("Nav", 80), "  " + line("foot", 12) + "\t"
    data = [(i, f"{nav}\n{foot.upper() if i % 2 else foot}\n{line(f'own{i}', 10)}", "h") for i in range(21)]  # above the limit
    data += [(100 + i, f"{nav}\n{line(f'new{i}', 60)}", "h") for i in range(5)] + [(200 + i, f"{foot}\n{line(f'other{i}', 60)}", "h2") for i in range(20)]  # kept; at the limit
    data += [(300 + i, "\n".join(line(f"copy{k}", 30) for k in range(3)), "h") for i in range(40)] + near_copies(1000, 60)  # one text; many texts
    data += [(400 + i, " ".join(rng.choice("a b c #x $ <p>".split()) for _ in range(rng.randint(0, 90))) + "\n" * i, None) for i in range(30)]
    data += [(None, None, None), (None, "", "h"), (500, line("z", 20_000), "h"), (500, line("z", 20_000), "h")]
    want = plain_rules(data)
    frame = spark.createDataFrame([(*r, 1, 2) for r in data], SCHEMA + ", _k1 int, row int")
    got = quality_rules(frame)
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed n_words_removed kept".split()
    assert sorted(map(str, got.select(columns).collect())) == sorted(str(Row(**dict(zip(columns, w, strict=True)))) for w in want)
    assert any(w[7] and not w[6] and not w[8] for w in want) and {"_k1", "row"} <= set(got.columns)
    kept = quality_filter(frame.repartition(5))
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(w[0] for w in want if w[8])
