"""Texts beyond 20 kB, columns that clash in token files, and the pipeline's stages on empty and null rows."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lectern.llm import bpe, repeats, token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def long_texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéèß") for _ in range(rng.randrange(1, 11)))
    passage = " ".join(word() for _ in range(90))
    texts = [" ".join(word() if rng.random() < 0.995 else rng.choice(["\n", "It's,", passage, "2024-01", "😀"]) for _ in range(n)) for n in (6000, 9000)]
    return [*texts, texts[0][5000:30_000] + passage, "ab" * 15_000, "é\n" * 12_000, passage]


def test_codec_of_long_texts(spark, long_texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    docs = spark.createDataFrame(list(enumerate(long_texts)), "doc_id long, text string")
    for r in bpe.encode_documents(docs, path).collect():
        ids = t.encode(long_texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == t.decode(ids, skip_special_tokens=False)


def test_repeats_in_long_texts(spark, long_texts):
    raw = [t.encode() for t in long_texts]
    seen = {}
    for x in raw:
        for i in range(len(x) - 199):
            h = hashlib.blake2b(x[i : i + 200], digest_size=12).digest()
            seen[h] = seen.get(h, 0) + 1
    want = {}
    for k, x in enumerate(raw):
        gone = np.zeros(len(x) + 2, bool)
        for i in range(len(x) - 199):
            if seen[hashlib.blake2b(x[i : i + 200], digest_size=12).digest()] > 1:
                gone[i + 1 : i + 201] = True
        want[k] = int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), bytes(np.frombuffer(x, np.uint8)[~gone[1:-1]])
    got = repeats.remove_repeats(spark.createDataFrame(list(enumerate(long_texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_removed"], len(r["span_starts"]), bytes(r["kept"])) for r in got} == want and sum(w[0] for w in want.values())


def test_token_files_of_long_texts_and_clashing_columns(spark, long_texts, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = [(i, x, "clash", 1, 2.0) for i, x in enumerate([None, "", *long_texts])] + [(3, "again", "clash", 1, 2.0), (3, "again", "clash", 1, 2.0), (None, "no id", "clash", 1, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, key int, there double").withColumnRenamed("there", "a.b").repartition(4)
    found = token_files.read_tokens(spark, token_files.write_tokens(docs, path, str(tmp_path / "t"))).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, row in zip(found, order, strict=True):
        ids = np.array([*t.encode(row[1] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (row[0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.read_tokens(spark, token_files.write_tokens(docs.limit(0), path, str(tmp_path / "none"))).count() == 0


def test_stages_on_empty_and_null_rows(spark, tmp_path):
    import corpus_pipeline

    empty = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3 + [(1, "", None, None, None)], SCHEMA)
    left = {"quality rules": 0, "line dedup": 4, "near dedup": 1, "source mix": 0, "bpe": 4}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0 and (name == "bpe" or out.columns == list(corpus_pipeline.COLUMNS))
        assert stage(spark, nulls, str(tmp_path)).count() == left[name], name
