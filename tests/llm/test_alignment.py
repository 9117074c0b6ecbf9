"""Alignment of two tokenizers against the libraries' own encodings, compared token by token."""

import hashlib
from collections import Counter, defaultdict

import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from lectern.llm import alignment, bpe, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", "one two  three   four ", "\n", "line one\nline two\r\n\tend", "<|endoftext|> <s></s> <unk> <0x41> plain", "mark ▁ here", "▁start", "é é   x​x ﬁ 　 naïve Straße ΣΑΣ 日本語 한국어",
    "😀😀 👨‍👩‍👧 \U0010ffff", "\x00 nul \x01", "1234567890 3.14 a1b2c3", "word " * 300, "!!!???...,,, --- ### $$", "don't we're I'll THE the The tHe", " leading and trailing ", "x" * 3000, "the cat sat on the mat. " * 1500,
]


@pytest.fixture(scope="module")
def models():
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    own.no_padding(), own.no_truncation()
    return own, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(models, text):
    """Ids and bytes of both tokenizers' tokens, empty where they don't give the text back."""
    own, model = models
    if not text:
        return [], [], [], []
    table = {c: b for b, c in bpe.byte_characters().items()}
    a, b = own.encode(f" {text}", add_special_tokens=False).ids, model.encode(text)
    bytes_a = [bytes(table[c] for c in own.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = f" {text}".encode()
    return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [], [], [])


def plain_alignment(models, text):
    a, b, bytes_a, bytes_b = plain_tokens(models, text)
    spans = lambda ids, raw: [(sum(map(len, raw[:i])), sum(map(len, raw[: i + 1])), t) for i, t in enumerate(ids)] if len(ids) < 50 else running(ids, raw)
    own, other = spans(a, bytes_a), spans(b, bytes_b)
    links, j = [], 0
    for s, e, t in own:
        while other[j][1] <= s:
            j += 1
        k = j
        while k < len(other) and other[k][0] < e:
            links.append((t, other[k][2]))
            k += 1
    cuts = sorted({e for _, e, _ in own} & {e for _, e, _ in other})
    groups, i, j = [], 0, 0
    for c in cuts:
        left, right = [], []
        while i < len(own) and own[i][1] <= c:
            left.append(own[i][2])
            i += 1
        while j < len(other) and other[j][1] <= c:
            right.append(other[j][2])
            j += 1
        groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""


def running(ids, raw):
    out, at = [], 0
    for t, x in zip(ids, raw, strict=True):
        out.append((at, at + len(x), t))
        at += len(x)
    return out


def plain_rows(models, rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row."""
    known = {t: plain_alignment(models, t) for t in {t for _, t in rows}}
    counts, best = Counter(), defaultdict(int)
    for _, t in rows:
        counts.update(known[t][3])
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(i, a, b, g, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), h) for i, t in rows for a, b, g, x, h in [known[t]]]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("often", [1, 64, 1 << 17])
def test_alignment(spark, models, often):
    rows = [*enumerate(TEXTS), (None, "the cat"), (4, "a"), (4, "a")]
    docs = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], "doc_id long, text string, pairs string, row int").repartition(3)
    done = alignment.align_tokenizers(docs, A, B, often)
    assert set(done.columns) == {*COLUMNS, "pairs", "row"}
    assert sorted(str(tuple(r)) for r in done.select(*COLUMNS).collect()) == sorted(map(str, plain_rows(models, rows)))
    assert alignment.align_tokenizers(docs.limit(0), A, B).count() == 0


def test_words_as_the_model_has_them(models):
    own = alignment.PieceTokens(B)
    assert own.by_words
    for texts in ([t for t in TEXTS if t], [x + y for x in ("a", " ", "é", "\n", "▁") for y in ("b", " ", "  c", "　", "<s>", "0")]):
        assert [x.tolist() for x in own.ids(texts)] == [models[1].encode(t) for t in texts]
    own.by_words = False
    assert [x.tolist() for x in own.ids(["a b", "c"])] == [models[1].encode("a b"), models[1].encode("c")]


def test_query(spark, models):
    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_token_alignment(spark, d)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == sorted(plain_rows(models, rows))


def test_letters_as_the_library_has_them():
    """Words of letters by the model alone, against whole encodings, in both kinds of file."""
    words = ["a", "the", "Straße", "naïve", "ǅǆɏ", "ª", "µm", "º", "Übergrößenträger", "don", "s", "THE", "endoftext", "x" * 70, "éèêë" * 30]
    own = bpe.Encoder(A)
    assert own.level is not None and bpe.Encoder(public_tokenizers.path("word_bpe_49k.json")).level is None
    keys = [*words, *(bpe.MARK + w for w in words), "3rd", "a_b", bpe.MARK + "\n", "日本"]
    assert own.make(keys) == own.whole([bpe.piece_of(k) for k in keys])
    assert all(bpe.LETTERS(w) for w in words) and not any(bpe.LETTERS(w) for w in ("3rd", "a_b", "×", "÷", "", "日本", "a\n", "\n"))
