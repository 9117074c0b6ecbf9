"""BPE encoding with content-defined chunks that documents share, and decoding.

A text is cut into chunks where a rolling hash of the bytes before a space says so; equal passages
so yield equal chunks wherever they stand. A worker encodes a chunk once and reuses it for every
document that it meets it in. Where chunks join, the words on both sides are encoded again
together, more of them each time, until that agrees with the chunks' ids; a join that never
agrees leaves the whole text to be encoded in one go.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import replacing, set_aside

#: The characters of Unicode's White_Space, in which every tokenizer here breaks words.
SPACE = r"[ \t\n\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Marks a piece that has no space before it.
MARK = "\x01"
#: A piece as marked that holds no white space but what comes before it.
PLAIN = re.compile(rf"{MARK}?[^\s{MARK}]+").fullmatch
#: A piece of Latin letters, the same in all versions of Unicode in use.
LETTERS = re.compile(rf"{MARK}?[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
CHUNK_MASK = 127
BATCH_CHARS = 1_000_000


class Memo:
    """A bounded cache in two generations: what isn't used in one generation goes."""

    def __init__(self, limit: int, longest: int = 256):
        self.limit, self.longest, self.new, self.old = limit, longest, {}, {}

    def get(self, keys: list, make) -> list:
        """The values of distinct keys; ``make(keys)`` gives values for those unknown. Long keys
        aren't kept, and a full generation becomes the old one."""
        out = list(map(self.new.get, keys))
        lost = [i for i, v in enumerate(out) if v is None]
        old = list(map(self.old.get, [keys[i] for i in lost]))
        missing = [i for i, v in zip(lost, old, strict=True) if v is None]
        for i, v in zip(lost, old, strict=True):
            if v is not None:
                out[i] = self.new[keys[i]] = v
        for i, v in zip(missing, make([keys[i] for i in missing]), strict=True):
            out[i] = v
            if len(keys[i]) <= self.longest:
                self.new[keys[i]] = v
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        return out


class Encoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does, with
    ids as little-endian bytes: two for each id if the vocabulary allows, else four."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4")
        self.pieces, self.chunks = Memo(200_000, 64), Memo(8_000, 4096)
        #: What stands between pieces that are encoded in one go, and its one id.
        self.between = next((x for x in ("\n", "\n~\n", "\n_\n") if len(self.whole([x])[0]) == self.dtype.itemsize), None)
        self.between_id = None if self.between is None else np.frombuffer(self.whole([self.between])[0], self.dtype)[0]
        #: Of a byte-level file that splits by the usual pattern, the characters that stand for bytes: its model takes words of letters directly.
        self.level = byte_characters() if self.is_byte_level() else None
        self.code = "H" if self.dtype.itemsize == 2 else "I"

    def is_byte_level(self) -> bool:
        parts = json.loads(self.tokenizer.to_str())
        split, model = parts["pre_tokenizer"] or {}, parts["model"]
        plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        return bool(plain and parts["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout") and not any(a["content"].isalpha() for a in parts["added_tokens"]))

    def letters(self, keys: list[str]) -> list[bytes]:
        """Ids of pieces of nothing but Latin letters, with or without the space before: the pattern leaves those whole, so
        the model alone is asked."""
        tokenize, code, space = self.tokenizer.model.tokenize, self.code, self.level[32]
        spelled = [(k[1:] if k[0] == MARK else space + k) if k.isascii() else piece_of(k).encode().decode("latin-1").translate(self.level) for k in keys]
        return [array(code, [t.id for t in tokenize(x)]).tobytes() for x in spelled]

    def whole(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.dtype.itemsize == 2 else "I"
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def each(self, keys: list[str], together: int = 256) -> list[bytes]:
        """Ids of pieces as marked that hold no white space: many are encoded as one text and told
        apart by the id between them. Where that id is met more often than it was put in, and where
        no mark has an id of its own, they are encoded one by one."""
        groups = [keys[i : i + together] for i in range(0, len(keys), together)]
        if self.between is None:
            return self.whole([piece_of(k) for k in keys])
        start, size, out = f"{self.between} ", self.dtype.itemsize, []
        # A space before each piece but for those marked as having none.
        joined = [(start + start.join(g)).replace(start + MARK, self.between)[len(self.between) :] for g in groups]
        for group, ids in zip(groups, self.whole(joined), strict=True):
            at = np.flatnonzero(np.frombuffer(ids, self.dtype) == self.between_id) * size
            if len(at) == len(group) - 1:
                out += [ids[a:z] for a, z in zip([0, *(at + size).tolist()], [*at.tolist(), len(ids)], strict=True)]
            else:
                out += self.whole([piece_of(k) for k in group])
        return out

    def by_pieces(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, every distinct piece being encoded once.

        A piece is a word with the one space before it, a line end, the word after it, or the
        punctuation that follows a plain letter. No token crosses from one piece into the next, and
        none depends on the pieces around it, as long as white space stands one by one; texts in
        which it doesn't are encoded whole."""
        out: list[bytes] = [b""] * len(texts)
        col = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(col, f"{SPACE}{SPACE}|{MARK}").to_numpy(zero_copy_only=False)
        for i, ids in zip(np.flatnonzero(odd), self.whole([texts[i] for i in np.flatnonzero(odd)]), strict=True):
            out[i] = ids
        plain = np.flatnonzero(~odd)
        if not len(plain):
            return out
        col = pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), col.take(pa.array(plain)), pa.scalar("", pa.large_string()))
        col = pc.replace_substring(col, "\n", f" {MARK}\n {MARK}")
        col = pc.replace_substring_regex(col, "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([-,.!?;:*#$%&)])", f"\\1 {MARK}\\2")
        split = pc.split_pattern(col, " ")
        coded = split.flatten().dictionary_encode()
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist
        held = self.pieces.get(keys, self.make)
        lengths = np.fromiter(map(len, held), np.int64, len(held)) // self.dtype.itemsize
        flat, first = np.frombuffer(b"".join(held), self.dtype), np.cumsum(lengths) - lengths
        index = coded.indices.to_numpy()
        n = lengths[index]
        end = np.cumsum(n)
        ids = flat[np.repeat(first[index] - (end - n), n) + np.arange(end[-1])]
        stops = np.concatenate(([0], end))[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for i, a, z in zip(plain.tolist(), stops[:-1].tolist(), stops[1:].tolist(), strict=True):
            out[i] = ids[a:z].tobytes()
        return out

    def make(self, keys: list[str]) -> list[bytes]:
        """Ids of pieces as marked. Words of letters are asked of the model alone where it can be; those that
        hold white space after their start go one by one."""
        if self.level is not None and (words := [k for k in keys if LETTERS(k)]):
            rest = [k for k in keys if not LETTERS(k)]
            known = dict(zip(words, self.letters(words), strict=True)) | dict(zip(rest, self.split(rest), strict=True))
            return [known[k] for k in keys]
        return self.split(keys)

    def split(self, keys: list[str]) -> list[bytes]:
        plain = [k for k in keys if PLAIN(k)]
        if len(plain) == len(keys):
            return self.each(keys)
        rest = [k for k in keys if not PLAIN(k)]
        known = dict(zip(rest, self.whole([piece_of(k) for k in rest]), strict=True)) | dict(zip(plain, self.each(plain), strict=True))
        return [known[k] for k in keys]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids by chunks."""
        cut = [chunks_of(t) for t in texts]
        keys = list(set().union(*cut))
        known = dict(zip(keys, self.chunks.get(keys, self.by_pieces), strict=True))
        bad = self.disagreeing(cut)
        return [b"".join(map(known.__getitem__, c)) if i not in bad else self.whole([texts[i]])[0] for i, c in enumerate(cut)]

    def disagreeing(self, cut: list[list[str]]) -> set[int]:
        """Texts of which some join of chunks doesn't hold however many words are encoded together."""
        joins = [(i, k) for i, c in enumerate(cut) for k in range(1, len(c))]
        words = 1
        while joins and words <= 64:
            ends = [(last_words(cut[i][k - 1], words), first_words(cut[i][k], words)) for i, k in joins]
            done, left, right = self.whole([a + b for a, b in ends]), self.whole_once([a for a, _ in ends]), self.whole_once([b for _, b in ends])
            joins = [j for j, both, a, b in zip(joins, done, left, right, strict=True) if both != a + b]
            words *= 4
        return {i for i, _ in joins}

    def whole_once(self, texts: list[str]) -> list[bytes]:
        """As whole, equal texts being encoded once."""
        known = dict.fromkeys(texts)
        known = dict(zip(known, self.whole(list(known)), strict=True))
        return [known[t] for t in texts]

    def decode(self, ids: bytes) -> str:
        return self.tokenizer.decode(np.frombuffer(ids, self.dtype).tolist(), skip_special_tokens=False)


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others
    in order from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def piece_of(key: str) -> str:
    """The piece that a key stands for: marked ones have no space before them."""
    return key[1:] if key[:1] == MARK else f" {key}"


def chunks_of(text: str) -> list[str]:
    """Cuts before a single space or line end between words where the hash of the 8 bytes before it
    has its low bits clear: a chunk of about a kilobyte. Any text that stands in two documents is cut
    alike in both but for its ends."""
    raw = text.encode()
    if len(raw) < 512:
        return [text]
    b = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((b[8:-1] == 32) | (b[8:-1] == 10)) + 8
    at = at[(b[at - 1] > 32) & (b[at - 1] < 127) & (b[at + 1] > 32) & (b[at + 1] < 127)]  # plain characters on both sides
    h = np.zeros(len(at), np.uint64)
    for k in range(8, 0, -1):
        h = (h << np.uint64(8)) | b[at - k]
    h *= np.uint64(0x9E3779B97F4A7C15)
    at = at[(h >> np.uint64(40)) & np.uint64(CHUNK_MASK) == 0]
    if not len(at):
        return [text]
    edges = [0, *at.tolist(), len(raw)]
    return [raw[a:z].decode() for a, z in zip(edges, edges[1:], strict=False)]


def last_words(text: str, n: int) -> str:
    at = len(text)
    for _ in range(n):
        if at <= 0 or (at := max(text.rfind(" ", 0, at), text.rfind("\n", 0, at))) < 0:
            return text
    return text[at:]


def first_words(text: str, n: int) -> str:
    at = 0
    for _ in range(n):
        found = [x for x in (text.find(" ", at + 1), text.find("\n", at + 1)) if x > 0]
        if not found:
            return text
        at = min(found)
    return text[:at]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process, so that its caches outlive a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def batches(texts: list[str]) -> Iterator[slice]:
    """Slices of about BATCH_CHARS characters; a longer text is one by itself."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_CHARS:
            yield slice(start, i)
            start = i
            size = 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def encode_documents(docs: DataFrame, tokenizer: str, finish: Callable[[Encoder, list[bytes]], dict[str, list]] | None = None, schema: str = "ids array<int>, decoded string", text: str = "text") -> DataFrame:
    """Encodes whole texts and decodes them again.

    ``tokenizer`` is a tokenizers file that every executor can read. ``finish(encoder, ids)`` turns
    a batch of encoded texts into the columns of ``schema``; by default the ids and the decoded
    text. Null and empty texts have no ids, equal rows get equal results, an empty table gives an
    empty one, ids play no part. No text moves and none is looked at beyond its own task.
    Returns the columns of ``docs`` but the text (those of ``schema`` are replaced, any other name is
    kept), and ``schema``.
    """
    new = [part.split()[0] for part in schema.split(", ")]
    inner, back = set_aside(replacing(docs, *[n for n in new if n != text]), text)
    finish = finish or both

    def run(texts: pd.Series) -> pd.DataFrame:
        own, texts, out = encoder(tokenizer), [t or "" for t in texts], []
        for s in batches(texts):
            out.append(pd.DataFrame(finish(own, own.encode(texts[s])), columns=new))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=new)

    done = docs.select(*inner, F.pandas_udf(run, schema)(F.col(f"`{text}`")).alias("encoded"))
    return done.select(*back, *[F.col(f"encoded.{n}") for n in new])


def both(own: Encoder, ids: list[bytes]) -> dict[str, list]:
    return {"ids": [np.frombuffer(x, own.dtype).astype(np.int32) for x in ids], "decoded": [own.decode(x) for x in ids]}


def digests(own: Encoder, ids: list[bytes]) -> dict[str, list]:
    """n_tokens, ids_sha256 (of decimal ids joined by a space) and decoded_sha256."""
    from hashlib import sha256

    lists = [np.frombuffer(x, own.dtype).tolist() for x in ids]
    return {
        "n_tokens": [len(x) for x in lists],
        "ids_sha256": [sha256(" ".join(map(str, x)).encode()).hexdigest() for x in lists],
        "decoded_sha256": [sha256(own.tokenizer.decode(x, skip_special_tokens=False).encode()).hexdigest() for x in lists],
    }
