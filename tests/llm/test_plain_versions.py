"""Results that the other tests don't hold to a plain version, and columns with clashing names."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm import bpe, licenses, line_dedup, mixing, near_copies, neighbours, quality, queries, repeats, simhash, warc

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that some operator uses inside, or may one day.
CLASHES = "_k1 _k2 _n _times _encoded _cut _base _more _score _drops t h row x y doc at hash place around part hot spans places node root best own_id fingerprint_ c0 c1 pos line key id url payload record sha256 copy removed gone mark label".split()


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def corpus():
    rng = random.Random(11)
    own = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for k in range(6):
        base = own(120)
        texts.append(" ".join(base[:60]) + "\n" + " ".join(base[60:]))
        for changed in (1, 2, 3):
            t = list(base)
            for at in rng.sample(range(120), changed):
                t[at] = own(1)[0]
            texts.append(" ".join(t[:60]) + "\n" + " ".join(t[60:]))
    texts += ["  Share this Page\n" + " ".join(own(70)) for _ in range(12)] + [" ".join(own(80)) for _ in range(30)] + [None, "", "short text"]
    copy = " ".join(own(75))
    texts += [copy] * 5 + ["a b c " * 40]
    rng.shuffle(texts)
    return [(i, t, "en", ["s1", "s2", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]


def test_fingerprint_bit_by_bit():
    for t in (None, "", " \t", "One", "one two", "A b c D é x", "a b c a b c " * 30, " ".join(f"w{i}" for i in range(500))):
        w = WORDS.findall(lower(t or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        want = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
        assert simhash.fingerprint(t) & (2**64 - 1) == want


def test_digests(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    own, t = bpe.Encoder(path), Tokenizer.from_file(path)
    texts = ["", "one two\n\nthree", "naïve 😀 <|endoftext|>", "word " * 3000]
    got = bpe.digests(own, own.encode(texts))
    for i, x in enumerate(texts):
        ids = t.encode(x, add_special_tokens=False).ids
        assert got["n_tokens"][i] == len(ids) and got["ids_sha256"][i] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"][i] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_licenses_base_columns_and_labels(spark, monkeypatch):
    rng = random.Random(2)
    parts = [*licenses.PHRASES, *(t for t, _ in licenses.TEMPLATES), "under the", "MIT license,", "license", "cc", "by", "nc", "\n", "plain words here"]
    data = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for i in range(200)] + [(None, None), (1, ""), (900, "cc by nc cc by nc"), (901, "x " * 20_000 + "cc by nc")]
    got = licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, text string"))
    want = []
    for id, text in data:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        base = sorted({label for _, label in places})
        want.append((id, len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(base)))
    assert sorted(str(tuple(r)) for r in got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()) == sorted(map(str, want))
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got.collect())
    monkeypatch.setattr(licenses, "with_rare_words", lambda docs, *_: docs)  # the first filter loses nothing
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted(map(str, got.collect())) == sorted(map(str, licenses.scan_licenses(docs).collect()))


def test_mix_columns(spark):
    data = corpus()
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    size = {r[0]: len(WORDS.findall(r[1] or "")) for r in data}
    total = Counter()
    for r in data:
        total[r[3]] += size[r[0]]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    left, open_, target = 1.5 * sum(total.values()), dict(zip(order, (3, 1, 2), strict=False)), {}
    while open_:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if share[s] > 2 * total[s]]
        for s in over or list(open_):
            target[s] = 2.0 * total[s] if over else share[s]
            open_.pop(s)
        left -= sum(target[s] for s in over)
    for r in got:
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[r["source"]]) and abs(r["target"] - target[r["source"]]) < 1e-6 and r["taken"] <= 2 * r["size"]
    for s in order:
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target[s]) <= 32


def test_spans_of_repeats_and_hot_triggers(spark, monkeypatch):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(450))
    noise = lambda n: "".join(rng.choice("ijklmnop ") for _ in range(n))
    texts = [noise(rng.randint(0, 150)) + passage[rng.choice((0, 30)) :] + noise(rng.randint(0, 150)) for _ in range(60)] + [noise(300) for _ in range(5)] + [None, "", passage + passage]
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    want = []
    for k, x in enumerate(raw):
        gone = [False] * len(x)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        want.append((k, len(x), sum(gone), sum(b and not a for a, b in zip([False, *gone], gone, strict=False))))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for least in (1, 10**6):
        found = repeats.hot_triggers
        monkeypatch.setattr(repeats, "hot_triggers", lambda parsed, least=least: found(parsed, 1, 1024, least))
        got = repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long"))
        assert sorted(map(tuple, got.collect())) == want
        monkeypatch.setattr(repeats, "hot_triggers", found)


def test_archive_does_not_depend_on_partitions(spark, tmp_path):
    big = "<p>x</p>" * 200
    df = spark.createDataFrame([(i // 2, f"u{i // 2}", big + str(i // 6)) for i in range(24)] + [(None, None, None)] * 2, "page_id long, url string, html string")
    read = lambda d, name: sorted(bytes(r["warc"]) for r in warc.read_records(spark, warc.write_archive(d, str(tmp_path / name))).collect())
    assert read(df.repartition(1), "a") == read(df.repartition(5, "url"), "b") and len(read(df, "c")) == 26


@pytest.mark.parametrize("name", ["encode_documents", "remove_repeats", "scan_licenses", "mixed", "mix", "quality_filter", "quality_rules", "one_of_each", "one_of_each_similar", "near_duplicates", "dedup_lines", "write_archive", "nearest"])
def test_columns_of_any_name(spark, tmp_path, name):
    """Each operator over a table with an extra column of every working name, and one with a dot."""
    docs = spark.createDataFrame(corpus(), SCHEMA).withColumns({c: F.lit(f"own {c}") for c in [*CLASHES, "a.b"]})
    if name == "write_archive":
        path = warc.write_archive(docs.drop("id"), str(tmp_path / "a"), id="doc_id", url="lang", payload="text")
        assert warc.read_index(spark, path).count() == docs.count()
        return
    if name == "nearest":
        vectors = docs.select("*", F.array(F.lit(1.0), F.col("doc_id").cast("double"), F.lit(2.0)).alias("v_"))
        assert neighbours.nearest(vectors, k=3, id="doc_id", vector="v_").count() == 3 * docs.count()
        return
    path = public_tokenizers.path("word_bpe_49k.json")
    calls = {"encode_documents": lambda d: bpe.encode_documents(d, path), "remove_repeats": repeats.remove_repeats, "scan_licenses": licenses.scan_licenses, "mixed": mixing.mixed, "mix": mixing.mix, "quality_filter": quality.quality_filter, "quality_rules": quality.quality_rules, "one_of_each": simhash.one_of_each, "one_of_each_similar": near_copies.one_of_each_similar, "near_duplicates": simhash.near_duplicates, "dedup_lines": line_dedup.dedup_lines}
    out = calls[name](docs)
    got = out.select([F.col(f"`{c}`") for c in [*CLASHES, "a.b"]]).distinct().collect()
    assert [list(r) for r in got] == [[f"own {c}" for c in [*CLASHES, "a.b"]]] and calls[name](docs.limit(0)).columns == out.columns


def test_run_of_the_pipeline(spark, tmp_path):
    """run() over a fixture: quality, line dedup and near dedup row by row, the mix by its targets, BPE by the tokenizer."""
    import corpus_pipeline
    from test_boilerplate import plain_rules
    from test_near_copies import first_of_each

    data = corpus()
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    kept = [r for r, v in zip(data, plain_rules([(r[0], r[1], r[3]) for r in data]), strict=True) if v[-1]]
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    seen = Counter(k for r in kept for k in {key(x) for x in r[1].split("\n")} if k)
    kept = [(r[0], "\n".join(x for x in r[1].split("\n") if seen[key(x)] < 10), *r[2:]) for r in kept]
    ids = first_of_each(kept)
    left = {r[0]: r[1] for r in kept if r[0] in ids}
    size, source = {i: len(WORDS.findall(t)) for i, t in left.items()}, {r[0]: r[3] for r in data}
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, times = corpus_pipeline.run(spark, str(tmp_path)).collect(), Counter()
    for r in rows:
        own = t.encode(left[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["source"]) == (len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest(), source[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(own, skip_special_tokens=False).encode()).hexdigest()
        times[r["doc_id"]] += 1
    assert max(times.values()) <= 2 and len(kept) < len(data) and len(left) < len(kept) - 15
    frame = spark.createDataFrame([(i, left[i], "en", source[i], 0) for i in left], SCHEMA)
    target = {r["source"]: r["target"] for r in mixing.mix(frame).collect()}
    for s, want in target.items():
        longest = max(n for i, n in size.items() if source[i] == s)
        assert abs(sum(times[i] * size[i] for i in left if source[i] == s) - want) <= 32 + longest


def test_queries_are_registered():
    assert sorted(queries.QUERIES, key=lambda n: int(re.findall(r"\d+", n)[0]))[0] == "op1_warc_archive" and len(queries.QUERIES) == 13
