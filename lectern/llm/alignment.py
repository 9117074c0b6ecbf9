"""Alignment of two tokenizers over the same bytes.

Both tokenizers' tokens tile a text's bytes. The texts of a batch are laid end to end; the ends of A's and
B's tokens are counted once over the whole of it. Where both end is a cut, and cuts make groups.
Every stretch between two neighbouring ends of either kind lies in one token of each, so the
stretches are the links. Prefix sums over the batch, taken at the documents' offsets, give each
document's figures.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.bpe import Encoder, Memo, byte_characters
from lectern.llm.common import materialise, replacing, set_aside

BATCH_CHARS = 500_000
SPACE_MARK = "▁"


class Vocabulary:
    """The bytes of each id, end to end, with their starts and lengths."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, joined."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.starts[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


class ByteTokens(Encoder):
    """A byte-level tokenizers file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        table = {c: b for b, c in byte_characters().items()}
        self.vocabulary = Vocabulary([bytes(table[c] for c in t) if t and all(c in table for c in t) else (t or "").encode() for t in map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, self.dtype) for x in self.by_pieces([f" {t}" for t in texts])]


class PieceTokens:
    """A sentencepiece model, which puts a space before each text.

    Where no piece has the space mark after another character, no token crosses from a character to the
    space after it, and a text's ids are those of its words, each with the spaces before it. So
    distinct words are encoded once; a model with other pieces encodes whole texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.by_words = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in names)
        self.words = Memo(200_000, 64)
        self.vocabulary = Vocabulary([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(names)])

    def make(self, words: list[str]) -> list[bytes]:
        return [array("i", x).tobytes() for x in self.model.encode(words, num_threads=1)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, np.intc) for x in (self.joined_words(texts) if self.by_words else self.make(texts))]

    def joined_words(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        # Spaces that don't stand one by one, and marks that stand in the text, are left to the model.
        odd = [i for i, t in enumerate(texts) if "  " in t or t[:1] == " " or t[-1:] == " " or SPACE_MARK in t]
        for i, x in zip(odd, self.make([texts[i] for i in odd]), strict=True):
            out[i] = x
        plain = [i for i in range(len(texts)) if out[i] is None]
        cut = [texts[i].split(" ") for i in plain]
        keys = list(set().union(*cut)) if cut else []
        known = dict(zip(keys, self.words.get(keys, self.make), strict=True))
        for i, words in zip(plain, cut, strict=True):
            out[i] = b"".join(map(known.__getitem__, words))
        return out


class Aligner:
    """Both tokenizers, and decimal ids ready to be joined."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokens(byte_path), PieceTokens(piece_path)
        top = max(len(self.a.vocabulary.lengths), len(self.b.vocabulary.lengths))
        width = len(str(top))
        self.digits = np.zeros((top, width + 1), np.uint8)
        left = np.arange(top)
        for k in range(width - 1, -1, -1):
            self.digits[:, k] = 48 + left % 10
            left = left // 10
        written = np.array([len(str(i)) for i in range(top)])
        self.used = np.arange(width + 1) >= width - written[:, None]

    def align(self, texts: list[str]) -> dict[str, list]:
        """For each text n_a, n_b, n_groups, n_links, groups_sha256, and its distinct pairs (a * 2**32 + b) with
        the number of links that join each."""
        raw = [f" {t}".encode() if t else b"" for t in texts]
        some = [i for i, r in enumerate(raw) if r]
        ids_a, ids_b = self.a.ids([texts[i] for i in some]), self.b.ids([texts[i] for i in some])
        sizes = np.array([len(raw[i]) for i in some], np.int64)
        good = self.same(raw, some, ids_a, self.a.vocabulary, sizes) & self.same(raw, some, ids_b, self.b.vocabulary, sizes)
        some, ids_a, ids_b = ([x for x, g in zip(l, good, strict=True) if g] for l in (some, ids_a, ids_b))
        n = len(texts)
        out = {"n_a": [0] * n, "n_b": [0] * n, "n_groups": [0] * n, "n_links": [0] * n, "groups_sha256": [""] * n, "pairs": [[]] * n, "times": [[]] * n}
        if not some:
            return out
        stops = np.cumsum(sizes[good])
        a, b = np.concatenate(ids_a).astype(np.int64), np.concatenate(ids_b).astype(np.int64)
        end_a, end_b = np.cumsum(self.a.vocabulary.lengths[a]), np.cumsum(self.b.vocabulary.lengths[b])
        total = int(stops[-1])
        ends_a, ends_b = np.bincount(end_a, minlength=total + 1), np.bincount(end_b, minlength=total + 1)
        cuts = np.cumsum((ends_a > 0) & (ends_b > 0))  # up to each place, itself included
        at = np.flatnonzero((ends_a > 0) | (ends_b > 0))  # where each link ends
        link_a, link_b = a[np.cumsum(ends_a)[at - 1]], b[np.cumsum(ends_b)[at - 1]]
        link_stops = np.searchsorted(at, stops, "right")
        group_stops = cuts[stops]
        per = lambda x: np.diff(x, prepend=0).tolist()
        groups = self.groups(a, b, cuts[end_a - 1], cuts[end_b - 1], group_stops)
        doc = np.repeat(np.arange(len(some)), np.diff(link_stops, prepend=0))
        pair = (link_a << 32) | link_b
        order = np.lexsort((pair, doc))
        pair, doc = pair[order], doc[order]
        new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1]))))
        times = np.diff(new, append=len(pair))
        pair_stops = np.searchsorted(new, link_stops, "left")
        pair = pair[new]
        n_links, n_groups = per(link_stops), per(group_stops)
        for k, i in enumerate(some):
            s = slice(pair_stops[k - 1] if k else 0, pair_stops[k])
            out["n_a"][i], out["n_b"][i], out["n_groups"][i], out["n_links"][i] = len(ids_a[k]), len(ids_b[k]), n_groups[k], n_links[k]
            out["groups_sha256"][i], out["pairs"][i], out["times"][i] = sha256(groups[k]).hexdigest(), pair[s], times[s]
        return out

    @staticmethod
    def same(raw: list[bytes], some: list[int], ids: list[np.ndarray], vocabulary: Vocabulary, sizes: np.ndarray) -> np.ndarray:
        """Which texts their tokens' bytes give back."""
        if not some:
            return np.zeros(0, bool)
        made = np.array([int(vocabulary.lengths[x].sum()) for x in ids], np.int64)
        alike = made == sizes
        keep = [k for k in range(len(some)) if alike[k]]
        if keep:
            got = vocabulary.joined(np.concatenate([ids[k] for k in keep]))
            want = np.frombuffer(b"".join(raw[some[k]] for k in keep), np.uint8)
            wrong = np.flatnonzero(got != want)
            if len(wrong):
                alike[np.array(keep)[np.searchsorted(np.cumsum(sizes[keep]), wrong, "right")]] = False
        return alike

    def groups(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, group_stops: np.ndarray) -> list[bytes]:
        """Each document's a1,a2|b1;a3|b2,b3. Tokens of both kinds in order of group, A's first, each followed by
        what stands after it."""
        place_a = np.arange(len(a)) + np.searchsorted(in_b, in_a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(in_a, in_b, "right")
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a[np.flatnonzero(np.diff(in_a, append=-1))]] = ord("|")
        after[place_b[np.flatnonzero(np.diff(in_b, append=-1))]] = ord(";")
        cells = self.digits[ids]
        cells[:, -1] = after
        used = self.used[ids]
        flat = cells[used].tobytes()
        written = np.cumsum(used.sum(axis=1))
        # A document's text ends before the mark after its last token.
        last = np.searchsorted(in_a, group_stops, "left") + np.searchsorted(in_b, group_stops, "left") - 1
        stops = written[last].tolist()
        return [flat[x : y - 1] for x, y in zip([0, *stops], stops, strict=False)]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One for each worker process."""
    if (byte_path, piece_path) not in _aligners:
        _aligners[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _aligners[byte_path, piece_path]


def batches(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


_OWN = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
_OWN_SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def aligned(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and n_a, n_b, n_groups, n_links, groups_sha256, and the distinct
    linked id pairs (a * 2**32 + b, ascending) with how many of the text's links join each: what can be said of a text by itself."""
    inner, back = set_aside(replacing(docs, *[n for n in _OWN if n != text]), text)

    def run(texts: pd.Series) -> pd.DataFrame:
        own, texts, out = aligner(byte_path, piece_path), [t or "" for t in texts], []
        for s in batches(texts):
            out.append(pd.DataFrame(own.align(texts[s]), columns=_OWN))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=_OWN)

    done = docs.select(*inner, F.pandas_udf(run, _OWN_SCHEMA)(F.col(f"`{text}`")).alias("own"))
    return done.select(*back, *[F.col(f"own.{n}") for n in _OWN])


def pair_counts(own: DataFrame) -> DataFrame:
    """(pair, count, best): the links that join each id pair in all texts, and whether no other pair with its B id has more."""
    links = own.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = materialise(links.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    low = F.lit((1 << 32) - 1)
    most = counts.groupBy(F.col("pair").bitwiseAND(low).alias("b")).agg(F.max("count").alias("most"))
    # Two tables no larger than the vocabularies' pairs: a B id has at most as many rows as A has ids.
    return materialise(counts.withColumn("b", F.col("pair").bitwiseAND(low)).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pair-best")


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str, often: int = 1 << 17, text: str = "text") -> DataFrame:
    """Aligns A, a byte-level tokenizers file, and B, a sentencepiece model, over whole texts with a space before each.

    Returns the columns of ``docs`` but the text (columns named as the new ones are replaced, any other name is kept), and
    n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups_sha256. A link joins an A and a B token whose bytes
    overlap; a pair's count is the number of links that join its ids in all texts; n_best are the links whose pair is the
    most frequent of its B id (ties included), count_sum adds up the counts over the links. Null and empty texts, and those whose tokens'
    bytes aren't the text's, have zeros and an empty digest. Equal rows get equal results, ids play no part, an empty table
    gives an empty one.

    Texts are encoded once, and what a text says by itself is written. Of all links, the pairs that hold more than one
    in ``often`` are at most ``often``, so that table is broadcast; every other pair is rare, and its rows meet its count
    in an exchange in which no key is hot.
    """
    new = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    inner, back = set_aside(replacing(docs, *[n for n in new if n != text]), text)
    named = docs.select(*inner, F.col(f"`{text}`").alias("t"))
    own = materialise(aligned(named, byte_path, piece_path, "t").withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(own)
    total = own.agg(F.sum("n_links")).first()[0] or 0
    many = F.col("count") > total / often
    each = own.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("times"))
    found = each.join(F.broadcast(counts.filter(many).withColumn("known", F.lit(True))), "pair", "left")
    sums = [F.sum(F.col("times") * F.col("best").cast("int")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    rare = found.filter(F.col("known").isNull()).select("row", "pair", "times").join(counts.filter(~many), "pair")
    # The frequent pairs' sums are made before the exchange, a row for each text.
    summed = found.filter("known").groupBy("row").agg(*sums).unionByName(rare.groupBy("row").agg(*sums)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    done = own.drop("pairs", "times").join(summed, "row", "left")
    return done.select(*back, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
