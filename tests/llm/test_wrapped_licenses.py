"""Notices that are wrapped over lines, and windows against plain ones."""

import random
import textwrap

import pytest

from lectern.llm import licenses
from lectern.llm.common import row_keys


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_wrapped_notices_are_found(spark, mark):
    wrapped = lambda i: "\n".join(mark + x for x in textwrap.wrap("Copyright 2020 by some authors. All is theirs. " + licenses.TEMPLATES[i][0] + " and so on.", 50))
    data = [(i, wrapped(i)) for i in range(len(licenses.TEMPLATES))] + [(100, "free software\n" * 40), (101, None)]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert all(label in got[i][0].split(",") and got[i][1] == 1.0 for i, (_, label) in enumerate(licenses.TEMPLATES))
    assert got[100] == got[101] == ("", 0.0)


def test_windows_against_all_windows(spark):
    rng, t = random.Random(5), 0.7
    words = [w for x, _ in licenses.TEMPLATES for w in licenses.template_words(x)] + ["filler"] * 20
    data = [(i, "\n".join(" ".join(rng.choices(words, k=4)) for _ in range(rng.randint(1, 30)))) for i in range(80)]
    for i in range(80, 160):
        own = rng.choice(licenses.TEMPLATES)[0].split()
        own = [w for w in own if rng.random() > 0.15]
        data.append((i, "\n".join(rng.choices(words, k=30) + own + rng.choices(words, k=30))))
    df = spark.createDataFrame(data, "doc_id long, text string")
    keys = {(r["_k1"], r["_k2"]): r["doc_id"] for r in df.select("doc_id", *row_keys("doc_id", "text")).collect()}
    got = {(keys[(r["_k1"], r["_k2"])], r["notice"]) for r in licenses.matching_windows(df, licenses.TEMPLATES, t, "doc_id", "text").collect()}
    want = set()
    for i, text in data:
        w = licenses.NOT_WORD_RE.sub(" ", text.lower()).split()
        for k, (x, _) in enumerate(licenses.TEMPLATES):
            mine, n = set(licenses.template_words(x)), -(-len(licenses.NOT_WORD_RE.sub(" ", x).split()) // t)
            if any(len(mine & set(w[s : s + int(n)])) >= t * len(mine) - 1e-9 for s in range(len(w))):
                want.add((i, k))
    assert got == want and len({i for i, _ in want if i >= 80}) > 20
