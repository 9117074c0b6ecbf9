"""The operators against plain versions, over rows with nulls, ties, repeats and odd texts."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm import bpe, licenses, line_dedup, mixing, neighbours, quality, repeats, simhash, token_files, warc
from lectern.llm.common import row_keys

LONG = "A line of several words that stands in many texts, word after word after word. " * 6
TEXTS = [
    None, "", " ", "one", "one\ntwo\nthree", LONG, LONG, LONG + "tail", "head " + LONG, "Straße ΣΑΣ é́ naïve x  y\t\tz\r\n\x85 end ",
    "Released under the MIT License.\nmore text here", "cc by nc cc by nc", "word " * 4000, "a b c a b c a b c " * 20, "<|endoftext|> #1 $$ 😀😀", "\n\n", "x" * 900, "x" * 900 + "y",
]
ROWS = [(i, t, "en", ["s1", "s2", None][i % 3], None if t is None else len(t), "clash") for i, t in enumerate(TEXTS)]
ROWS += [(5, LONG, "en", "s1", len(LONG), "clash"), (None, "one", None, None, 3, "clash")] + [(100 + i, f"common line\nown line {i} " + "w " * 60, "en", "s1", 80, "clash") for i in range(14)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long, n_lines string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def expected(columns, values):
    from pyspark.sql import Row

    return sorted(str(Row(**dict(zip(columns, v, strict=True)))) for v in values)


def test_line_dedup(docs, empty):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    seen = Counter(k for r in ROWS for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    want = []
    for r in ROWS:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < 10]
        want.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = line_dedup.dedup_lines(docs)
    assert rows(got, "doc_id", "n_lines", "n_dropped", "kept_text") == expected(("doc_id", "n_lines", "n_dropped", "kept_text"), want)
    assert any(w[2] for w in want) and line_dedup.dedup_lines(empty).count() == 0


def test_repeats(docs, empty):
    raw = [(r[1] or "").encode() for r in ROWS]
    seen = Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    want = []
    for r, x in zip(ROWS, raw, strict=True):
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = True
        want.append((r[0], len(x), int(gone.sum()), bytearray(b for b, g in zip(x, gone, strict=True) if not g)))
    got = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "kept")
    assert sorted(map(str, ((r[0], r[1], r[2], bytearray(r[3])) for r in got.collect()))) == sorted(map(str, want))
    assert repeats.remove_repeats(empty).count() == 0


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    prints = {r["fingerprint"] for r in got}
    near = {a: {b for b in prints if bin((a ^ b) & (2**64 - 1)).count("1") <= 2} for a in prints}
    for r in got:
        reached, todo = set(), [r["fingerprint"]]
        while todo:
            x = todo.pop()
            if x not in reached:
                reached.add(x)
                todo += near[x]
        ids = [q["doc_id"] for q in got if q["fingerprint"] in reached and q["doc_id"] is not None]
        assert r["component_id"] == min(ids)
    assert len(got) == len(ROWS) and simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_covering_finds_every_pair(spark, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(-(2**63), 2**63, 40)
    fps = set(base.tolist())
    for b in base.tolist():
        for n in range(1, 6):
            x = b & (2**64 - 1)
            for bit in rng.choice(64, n, replace=False):
                x ^= 1 << int(bit)
            fps.add(x - 2**64 if x >= 2**63 else x)
    got = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), distance).collect()}
    order = sorted(fps)
    assert got == {(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= distance}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert len({got[i] for i in range(301)}) == 1 and got[1000] == got[1001] != got[0]


def test_bpe(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    ids = [t.encode(r[1] or "", add_special_tokens=False).ids for r in ROWS]
    got = bpe.encode_documents(docs, path)
    assert rows(got, "doc_id", "ids", "decoded") == expected(("doc_id", "ids", "decoded"), [(r[0], i, t.decode(i, skip_special_tokens=False)) for r, i in zip(ROWS, ids, strict=True)])
    assert bpe.encode_documents(empty, path).count() == 0


def test_token_files(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    folder = token_files.write_tokens(docs, path)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want, start = [], 0
    for r in order:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.read_tokens(spark, folder)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == expected(("doc_id", "start", "n_tokens", "ids_crc32"), want)
    assert token_files.read_document(spark, folder, 3) == [*t.encode("one", add_special_tokens=False).ids, 0]
    assert token_files.read_tokens(spark, token_files.write_tokens(empty, path)).count() == 0


def test_warc(spark, tmp_path):
    big = "<p>x</p>" * 200
    pages = [(1, "http://a/", big), (2, "http://b/\n", big), (2, "http://b/\n", big), (3, None, None), (4, "u", ""), (None, "n", big), (5, "s", "small"), (6, "s", "small")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = warc.write_archive(df, str(tmp_path / "a"))
    got = warc.read_index(spark, path).collect()
    assert len(got) == len(pages) and sum(r["record_type"] == "revisit" for r in got) == 3
    assert {r["refers_to"] for r in got} == {None, "2"}
    assert all(r["payload_digest"] in {hashlib.sha1((p[2] or "").encode()).hexdigest() for p in pages} for r in got)
    for r in warc.read_records(spark, path).collect():
        head, _, block = bytes(r["warc"]).partition(b"\r\n\r\n")
        n = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert len(block) == n + 4 and block.endswith(b"\r\n\r\n")
        digest = re.search(rb"sha1:(\w+)", head)[1].decode()
        if b"WARC-Type: response" in head:
            import base64

            assert base64.b32encode(hashlib.sha1(block[:n].partition(b"\r\n\r\n")[2]).digest()).decode() == digest
    assert warc.read_index(spark, warc.write_archive(df.limit(0), str(tmp_path / "b"))).count() == 0


def test_quality(docs, empty):
    got = {(r["doc_id"], r["n_words"]): r for r in quality.quality_rules(docs, line_limit=3).collect()}
    assert got[(100, 65)]["kept"] is False  # its own line is mostly one word again and again
    assert got[(0, 0)]["base_failed"] and len(got) >= len(ROWS) - 2 and quality.quality_rules(empty).count() == 0


def test_depleted_documents_go_and_copies_stay(spark):
    boiler = " ".join(f"b{i}" for i in range(80))
    rest = lambda i: " ".join(f"own{i}x{j}" for j in range(10))
    family = "\n".join(" ".join(f"f{k}w{j}" for j in range(30)) for k in range(5))
    data = [(i, f"{boiler}\n{rest(i)}", "h") for i in range(40)] + [(100 + i, family, "h") for i in range(40)]
    kept = {r["doc_id"] for r in quality.quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string")).filter("kept").collect()}
    assert kept == set(range(100, 140))


def test_licenses(docs, empty):
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert (got[10]["base_labels"], got[10]["first_word"], got[10]["n_base"], got[10]["score"]) == ("mit", 1, 1, 1.0)
    assert (got[11]["n_base"], got[11]["first_word"], got[11]["last_word"], got[11]["n_words"]) == (2, 0, 3, 6)
    assert got[0]["n_words"] == 0 and got[0]["first_word"] is None and licenses.scan_licenses(empty).count() == 0


def test_license_join_against_all_lines(spark):
    import random

    random.seed(5)
    words = [w for t, _ in licenses.TEMPLATES for w in licenses.template_words(t)] + ["filler"] * 40
    data = [(i, " ".join(random.choices(words, k=random.randint(3, 40)))) for i in range(300)] + [(1000 + i, t) for i, (t, _) in enumerate(licenses.TEMPLATES)]
    got = licenses.matching_lines(spark.createDataFrame(data, "doc_id long, text string").select("*"), licenses.TEMPLATES, 0.5, "doc_id", "text")
    keys = {(r["_k1"], r["_k2"]): r["doc_id"] for r in spark.createDataFrame(data, "doc_id long, text string").select("doc_id", *row_keys("doc_id", "text")).collect()}
    found = {(keys[(r["_k1"], r["_k2"])], r["notice"]) for r in got.collect()}
    want = {(i, n) for i, t in data for n, (x, _) in enumerate(licenses.TEMPLATES) if len({*licenses.template_words(x)} & {*licenses.template_words(t)}) >= 0.5 * len(licenses.template_words(x)) - 1e-9}
    assert found == want


def test_sainte_lague():
    votes, caps = np.array([53.0, 24.0, 23.0, 0.0]), np.array([100, 100, 2, 5])
    for seats in (1, 7, 11, 50):
        got, want = mixing.sainte_lague(seats, votes, caps), [0] * 4
        for _ in range(seats):
            best = max((i for i in range(4) if want[i] < caps[i] and votes[i]), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))
            want[best] += 1
        assert got.tolist() == want
    assert mixing.water_fill(150, np.array([3.0, 1.0, 2.0]), np.array([20.0, 100.0, 80.0])).round(6).tolist() == [20.0, 50.0, 80.0]


def test_mix(docs, empty):
    got = mixing.mix(docs).collect()
    again = sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert sorted(map(str, got)) == again and len(got) == len(ROWS)
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 32 and all(r["taken"] <= 2 * r["size"] for r in own)
    assert mixing.mix(empty).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1200, 16)).astype(np.float32)
    x[600:620] = x[0]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0]), (None, [1.0] * 16), (3, x[3].tolist()), (5004, [None] * 16)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest(df, k=10, is_query=F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x, hits = x.astype(float), 0
    assert set(got) == {i for i in range(1200) if i % 20 == 0}
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:10]
        assert [f[0] for f in sorted(found)] == list(range(1, 11)) and all(abs(f[2] - s[f[1]]) < 1e-9 for f in found)
        hits += len(set(best.tolist()) & {f[1] for f in found})
    assert hits >= 0.9 * 10 * len(got)
    split = neighbours.nearest(df, k=10, is_query=F.col("vec_id") % 20 == 0, parts=4, probes=4, block_rows=50, query_rows=7).collect()  # all parts, in small blocks: exact
    for q in got:
        s = x @ x[q]
        s[q] = -np.inf
        assert [r["vec_id"] for r in sorted(split, key=lambda r: r["rank"]) if r["query_id"] == q] == np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:10].tolist()
    few = neighbours.nearest(df.filter("vec_id < 8"), k=10, is_query=F.col("vec_id") == 0).collect()
    assert len(few) == 7 and neighbours.nearest(df.limit(0)).count() == 0


def test_probes_are_measured():
    import pandas as pd

    p = np.array([[0.5, 0.3, 0.2], [0.1, 0.2, 0.7]])
    truth = pd.DataFrame({"q": [0, 0, 1, 1], "part": [0, 1, 2, 0]})  # places 0, 1, 0, 2
    assert [neighbours.probes_needed(p, truth, r) for r in (0.5, 0.75, 0.76, 1.0)] == [1, 2, 3, 3]
    assert [neighbours.parts_for(n, 4096) for n in (0, 10**4, 10**6, 10**8, 10**12)] == [16, 16, 64, 512, 512]


def test_few_probes_do_on_clustered_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((64, 16)) * 3
    x = centres[np.arange(6400) % 64] + 0.3 * rng.standard_normal((6400, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, k=20, is_query=F.col("vec_id") % 20 == 0, probes=3).collect()
    hits = 0
    for q in {r["query_id"] for r in got}:
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 20 * 320


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out.select("doc_id", "text", "lang", "source", "n_chars"), str(tmp_path))
        assert out.columns == list(corpus_pipeline.COLUMNS), name
        out.write.parquet(str(tmp_path / name.replace(" ", "-")))
        out = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
    assert corpus_pipeline.STAGES[-1][1](spark, out, "").count() == out.count()


@pytest.mark.parametrize("rows_a_frame", [1, 3, 7, 1000])
def test_spans_of_a_trigger_with_many_copies(rows_a_frame):
    import random

    import pandas as pd

    random.seed(5)
    kinds = [(random.randint(1, 2), low, high, bytes(random.choice(b"ab") for _ in range(high)), bytes(random.choice(b"ab") for _ in range(repeats.SIDE - low))) for low, high in [(98, 100), (99, 100), (0, 2), (0, 1)] * 4]
    rows = [(doc, h, (1000 + doc) << 16 | low << 8 | high, b + a, low, high, b, a) for doc, (h, low, high, b, a) in enumerate(random.choices(kinds, k=60) + kinds)]
    want = set()
    for doc, h, place, _, low, high, b, a in rows:
        for o in range(low, high + 1):
            if any(g == h and d2 != doc and l2 <= o <= h2 and b[:o] == b2[:o] and a[: repeats.SIDE - o] == a2[: repeats.SIDE - o] for d2, g, _, _, l2, h2, b2, a2 in rows):
                want |= {(doc, x) for x in range((place >> 16) - o, (place >> 16) - o + repeats.LENGTH)}
    rows.sort(key=lambda r: (r[1], r[2] & 0xFFFF, r[3]))
    frames = [pd.DataFrame([r[:4] for r in rows[i : i + rows_a_frame]], columns=["doc", "hash", "place", "around"]) for i in range(0, len(rows), rows_a_frame)]
    got = set()
    for f in repeats.find_spans(iter(frames)):
        for r in f.itertuples():
            got |= {(r.doc, x) for x in range(r.first, r.last)}
    assert want and got == want
