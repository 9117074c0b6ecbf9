"""Repeated passages over the whole corpus, byte-exact, by parsing at rolling-hash triggers.

A trigger is a string of K bytes whose rolling hash is the least of the LENGTH - K + 1 ones in
some LENGTH-byte window; so each window holds a trigger, and equal windows hold the same one at the
same place, whatever surrounds them. Triggers that stand once in the corpus rule out all windows
whose least trigger they are; that leaves the repetitive part of the parse. There, the places of a
trigger are put in corpus order: by the text after it (the order of the suffixes that start with
it) and by the text before it read backwards. Two windows around a trigger are equal if and only if
they share a class of both orders, which neighbours' common prefixes tell; so nothing is compared
pair by pair. (Triggers count as the same by their 64-bit hash, what is around them by its bytes.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import materialise, replacing, row_keys, set_aside

LENGTH, K = 200, 100
SIDE = LENGTH - K
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
CHUNK_ROWS = 20_000
#: About how many places of a trigger that stands very often go to one group.
SPREAD = 2048
_SPANS, _HEADS = "doc long, first long, last long", "hash long, place long, around binary"
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if len(held := _powers.get(base, ())) < n:
        p = np.full(max(n, 1 << 17), base, np.uint64)
        p[0] = 1
        held = _powers[base] = np.cumprod(p)
    return held


def trigger_hashes(raw: bytes) -> np.ndarray:
    """The rolling hash, scrambled, of the K bytes from each position."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(b * powers(_BASE, len(b))[: len(b)], out=sums[1:])
    h = (sums[K:] - sums[:-K]) * powers(_INVERSE, len(b))[: len(b) - K + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding(h: np.ndarray, width: int, op: np.ufunc, fill: int) -> np.ndarray:
    """op over each window of ``width``, in three passes whatever the width."""
    padded = np.full(-(-len(h) // width) * width, fill, np.uint64)
    padded[: len(h)] = h
    blocks = padded.reshape(-1, width)
    ahead = op.accumulate(blocks, axis=1).ravel()
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: len(h) - width + 1], ahead[width - 1 : len(h)])


def triggers(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of triggers, all hashes, least hash of each window)."""
    h = trigger_hashes(raw)
    least = sliding(h, SIDE + 1, np.minimum, 2**64 - 1)
    none = np.zeros(SIDE, np.uint64)
    return np.flatnonzero(h == sliding(np.concatenate((none, least, none)), SIDE + 1, np.maximum, 0)), h, least


def find_triggers(text: str) -> Column:
    def own(texts: pd.Series) -> pd.DataFrame:
        at, hashes = [], []
        for t in texts:
            raw = (t or "").encode()
            if len(raw) < LENGTH:
                at.append([])
                hashes.append([])
                continue
            a, h, _ = triggers(raw)
            at.append(a.astype(np.int32))
            hashes.append(h[a].view(np.int64))
        return pd.DataFrame({"at": at, "hash": hashes})

    return F.pandas_udf(own, "at array<int>, hash array<long>")(F.col(f"`{text}`"))


def text_dictionary(docs: DataFrame, text: str, sample_docs: int = 1000, sample_chars: int = 16_384, size: int = 112_640) -> bytes:
    """A zstandard dictionary from a bounded sample of texts, chosen by hash; it just makes the texts
    that travel smaller, and is empty where there's too little to train on."""
    short = docs.filter(F.char_length(f"`{text}`") <= sample_chars).select(F.xxhash64(f"`{text}`").alias("h"), F.col(f"`{text}`").alias("t"))
    chosen = [r["h"] for r in short.select("h").distinct().orderBy("h").limit(sample_docs).collect()]
    if not chosen:
        return b""
    texts = [r["t"].encode() for r in short.filter(F.col("h").isin(chosen)).groupBy("h").agg(F.first("t").alias("t")).orderBy("h").collect()]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b""


def unpacker(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def packed(text: str, dictionary: bytes) -> Column:
    """Texts as they travel: compressed."""

    def own(texts: pd.Series) -> pd.Series:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=6)
        press = zstandard.ZstdCompressor(level=6, dict_data=shared)
        return pd.Series([press.compress((t or "").encode()) for t in texts], dtype=object)

    return F.pandas_udf(own, "binary")(F.col(f"`{text}`"))


def contexts(dictionary: bytes) -> Column:
    """For given triggers of a text: the offsets at which windows have it as their least trigger
    (bytes of the window before it, from ``low`` to ``high``), packed with its position, and the
    bytes before (backwards) and after it that these windows hold, end to end."""

    def own(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        unpress, rows = unpacker(dictionary), []
        for t, at in zip(texts, places, strict=True):
            raw = unpress.decompress(t)
            at = np.unique(np.asarray(at, np.int64))
            h = trigger_hashes(raw)
            least = sliding(h, SIDE + 1, np.minimum, 2**64 - 1)
            first = at[:, None] + np.arange(-SIDE, 1)
            inside = (first >= 0) & (first < len(least))
            own_window = inside & (least[np.clip(first, 0, len(least) - 1)] == h[at][:, None])
            high, low = SIDE - own_window.argmax(axis=1), own_window[:, ::-1].argmax(axis=1)
            rows.append((
                h[at].view(np.int64), (at << 16) + (low << 8) + high,
                [raw[p - n : p][::-1] + raw[p + K : p + LENGTH - m] for p, n, m in zip(at.tolist(), high.tolist(), low.tolist(), strict=True)],
            ))
        return pd.DataFrame(rows, columns=["hash", "place", "around"])

    return F.pandas_udf(own, "hash array<long>, place array<long>, around array<binary>")("t", "places")


def standing_twice(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows in order of hash, those that share it with the row before or after. Rows stream
    through; of those before just the last is kept."""
    last: pd.DataFrame | None = None  # a row that may still turn out to have a twin
    matched = False  # whether it has been given out
    for f in frames:
        if last is not None:
            f = pd.concat([last, f], ignore_index=True)
        h = f["hash"].to_numpy()
        same = h[1:] == h[:-1]
        twice = np.zeros(len(h), bool)
        twice[1:] |= same
        twice[:-1] |= same
        out = twice.copy()
        if matched:
            out[0] = False
        last, matched = f.iloc[-1:], bool(twice[-1]) or (matched and len(h) == 1)
        yield f.loc[out, ["doc", "at"]]


def order_classes(groups: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of (group, string), and what each has in common with the one before it in that
    order: -1 in another group."""
    n = len(strings)
    raw = np.frombuffer(b"".join(s.ljust(104, b"\0") for s in strings), np.uint8).reshape(n, 104)
    words = raw.view(">u8").astype(np.uint64)
    order = np.lexsort([*(words[:, i] for i in range(12, -1, -1)), groups])
    ranked = raw[order]
    differ = ranked[1:, :SIDE] != ranked[:-1, :SIDE]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), SIDE)
    common[groups[order][1:] != groups[order][:-1]] = -1
    return order, np.concatenate(([-1], common))


def repeated_offsets(groups: np.ndarray, low: np.ndarray, high: np.ndarray, before: list[bytes], after: list[bytes]) -> np.ndarray:
    """By row and offset, whether the window is equal to another row's of the group."""
    n = len(groups)
    orders = [order_classes(groups, x) for x in (before, after)]
    out = np.zeros((n, SIDE + 1), bool)
    classes = [np.empty(n, np.int64), np.empty(n, np.int64)]
    for offset in range(SIDE + 1):
        rows = np.flatnonzero((low <= offset) & (offset <= high))
        if len(rows) < 2:
            continue
        for (order, common), held, length in zip(orders, classes, (offset, SIDE - offset), strict=True):
            held[order] = np.cumsum(common < length)
        key = classes[0][rows] * (n + 1) + classes[1][rows]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(rows), bool)
        twice[1:] |= same
        twice[:-1] |= same
        out[rows[by[twice]], offset] = True
    return out


def hot_triggers(parsed: DataFrame, one_in: int = 64, most: int = 1024, least: int = 16) -> dict[int, list[int]]:
    """Triggers that stand very often, judged by one in ``one_in`` documents, by the number of groups over
    which their places are to be spread (a power of 4); at most ``most``, as each has that share of the
    places counted. They're a hint by which places are dealt out evenly; whatever they are, the
    results are the same."""
    some = parsed.filter(F.pmod(F.xxhash64("doc"), F.lit(one_in)) == 0).select(F.explode("hash").alias("hash"))
    counts = materialise(some.groupBy("hash").count().filter(F.col("count") >= least), "repeats-often")
    total = counts.agg(F.sum("count")).head()[0] or 0
    groups: dict[int, list[int]] = {}
    for r in counts.filter(F.col("count") * most >= total).orderBy("hash").collect():
        n = 4
        while n * SPREAD < r["count"] * one_in:
            n *= 4
        groups.setdefault(n, []).append(r["hash"])
    return groups


def spans_and_heads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """As find_spans, for rows with ``part``: those of part 0 or more aren't compared with other surroundings of
    their trigger; the first of each surroundings in each part goes out too (hash, place, around), to
    meet the others' once more."""
    return find_spans(frames, heads=True)


def find_spans(frames: Iterator[pd.DataFrame], heads: bool = False) -> Iterator[pd.DataFrame]:
    """Rows of one trigger stand together, and of those the rows with equal surroundings. Gives the
    byte spans that repeated windows cover.

    Rows with equal surroundings repeat each other in all their windows, so their spans are given as
    they stream by; just the first stays, to be compared with other surroundings of its trigger."""

    def spans(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> pd.DataFrame:
        out = pd.DataFrame({"doc": doc, "first": first, "last": last})
        if heads:
            out = out.assign(hash=pd.Series([None] * len(out), dtype="Int64"), place=pd.Series([None] * len(out), dtype="Int64"), around=pd.Series([None] * len(out), dtype=object))
        return out

    def done(f: pd.DataFrame) -> pd.DataFrame:
        groups = f["hash"].to_numpy(np.int64)
        place, around = f["place"].to_numpy(np.int64), f["around"].tolist()
        low, high = place >> 8 & 255, place & 255
        before, after = [a[:n] for a, n in zip(around, high.tolist(), strict=True)], [a[n:] for a, n in zip(around, high.tolist(), strict=True)]
        twice = repeated_offsets(groups, low, high, before, after)
        edge = np.diff(np.pad(twice, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)
        at = (place >> 16)[row]
        return spans(f["doc"].to_numpy()[row], at - (last - 1), at - first + LENGTH)

    held: list[pd.DataFrame] = []
    last: pd.DataFrame | None = None  # a row whose like may still come
    matched = False  # whether its span has been given out
    for f in frames:
        carried = last is not None
        if carried:
            f = pd.concat([last, f], ignore_index=True)
        h, place, around = f["hash"].to_numpy(), f["place"].to_numpy(np.int64), f["around"].to_numpy()
        same = (h[1:] == h[:-1]) & ((place[1:] & 0xFFFF) == (place[:-1] & 0xFFFF)) & (around[1:] == around[:-1]).astype(bool)
        twice, fresh = np.zeros(len(f), bool), np.ones(len(f), bool)
        twice[1:] |= same
        twice[:-1] |= same
        fresh[1:] = ~same
        fresh[0] = not carried
        last, matched, given = f.iloc[-1:], bool(twice[-1]) or (matched and len(f) == 1), matched
        if given:
            twice[0] = False
        at = place[twice] >> 16
        yield spans(f["doc"].to_numpy()[twice], at - (place[twice] & 255), at - (place[twice] >> 8 & 255) + LENGTH)
        if heads:
            apart = fresh & (f["part"].to_numpy() >= 0)
            first = f.loc[apart, ["doc", "hash", "place", "around"]].reset_index(drop=True)
            yield first.assign(first=pd.Series([None] * len(first), dtype="Int64"), last=pd.Series([None] * len(first), dtype="Int64"))[["doc", "first", "last", "hash", "place", "around"]]
            fresh &= ~apart
        held.append(f[fresh])
        if sum(map(len, held)) >= CHUNK_ROWS:
            whole = pd.concat(held, ignore_index=True)
            h = whole["hash"].to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if (h != h[-1]).any() else 0
            if cut:
                yield done(whole.iloc[:cut].reset_index(drop=True))
            held = [whole.iloc[cut:]]
    if held and sum(map(len, held)):
        yield done(pd.concat(held, ignore_index=True))


def cut_spans(dictionary: bytes) -> Column:
    def own(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        unpress, rows = unpacker(dictionary), []
        for t, found in zip(texts, spans, strict=True):
            raw = unpress.decompress(t)
            if found is None or not len(found):
                rows.append((len(raw), 0, [], [], raw))
                continue
            pairs = sorted((s["first"], s["last"]) for s in found)
            merged = [list(pairs[0])]
            for a, z in pairs[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(z, merged[-1][1])
                else:
                    merged.append([a, z])
            stays = [raw[a:z] for (_, a), (z, _) in zip([(0, 0), *merged], [*merged, (len(raw), 0)], strict=True)]
            rows.append((len(raw), sum(z - a for a, z in merged), [a for a, _ in merged], [z for _, z in merged], b"".join(stays)))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "span_starts", "span_ends", "kept"])

    return F.pandas_udf(own, "n_bytes long, n_removed long, span_starts array<long>, span_ends array<long>, kept binary")("t", "spans")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Removes each byte that a LENGTH-byte string covers which starts anywhere else too, in the same
    or another document; strings are judged on the input.

    Null texts are empty; texts shorter than LENGTH keep all. Rows are documents: equal rows repeat
    each other, ids may be null or repeat. An empty table gives an empty one. Returns the columns of
    ``docs`` but the text (names below are replaced, any other is kept) and ``n_bytes``,
    ``n_removed``, ``span_starts`` and ``span_ends`` (of the maximal removed runs), and ``kept``
    (binary, as a cut may part a character).

    What is exchanged: a hash and a place for each trigger; the surroundings of those triggers
    that stand twice or more; and the texts, compressed, once to look the surroundings up and once to
    cut. The places of one trigger pass through one task in order, but for the triggers that stand
    very often: their places are spread, equal surroundings meet within each part, and one of each
    goes on to meet those of the other parts. So a task holds the distinct surroundings of a trigger at
    a time, however many copies there are of each.
    """
    base = replacing(docs, *[n for n in ("n_bytes", "n_removed", "span_starts", "span_ends", "kept") if n not in (id, text)])
    inner, back = set_aside(base, text)
    parsed = docs.select(*row_keys(id, text), find_triggers(text).alias("x")).select(F.monotonically_increasing_id().alias("doc"), "_k1", "_k2", "x.at", "x.hash")
    parsed = materialise(parsed.filter(F.size("at") > 0), "repeats-parse")
    hot = hot_triggers(parsed)
    often = F.col("hash").isin([h for hashes in hot.values() for h in hashes])
    group = [F.when(F.col("hash").isin(hashes), F.pmod(F.xxhash64("doc", "place"), F.lit(n))) for n, hashes in hot.items()]
    places = parsed.select("doc", F.explode(F.arrays_zip("at", "hash")).alias("x")).select("doc", "x.at", "x.hash")
    rare = places.filter(~often).repartition("hash").sortWithinPartitions("hash").mapInPandas(standing_twice, "doc long, at int")
    left = rare.union(places.filter(often).select("doc", "at")).groupBy("doc").agg(F.collect_list("at").alias("places"))
    keys = parsed.groupBy("_k1", "_k2").agg(F.min("doc").alias("doc"))  # equal rows share their places
    left = left.join(keys, "doc")
    dictionary = text_dictionary(docs, text)
    travelling = docs.select(*row_keys(id, text), packed(text, dictionary).alias("t"))
    around = travelling.join(left, ["_k1", "_k2"]).select("doc", contexts(dictionary).alias("x"))
    around = around.select("doc", F.explode(F.arrays_zip("x.hash", "x.place", "x.around")).alias("y"))
    around = around.select("doc", *[F.col(f"y.{c}").alias(c) for c in ("hash", "place", "around")])
    around = around.select("doc", "hash", "place", "around", F.coalesce(*group, F.lit(-1)).cast("int").alias("part"))
    order = (F.col("place").bitwiseAND(F.lit(0xFFFF)), "around")
    found = around.repartition("hash", "part").sortWithinPartitions("hash", "part", *order).mapInPandas(spans_and_heads, f"{_SPANS}, {_HEADS}")
    found = materialise(found, "repeats-found")
    heads = found.filter("hash is not null").select("doc", "hash", "place", "around").repartition("hash").sortWithinPartitions("hash", *order)
    spans = found.filter("first is not null").select("doc", "first", "last").union(heads.mapInPandas(find_spans, _SPANS))
    spans = spans.groupBy("doc").agg(F.collect_set(F.struct("first", "last")).alias("spans")).join(keys, "doc").drop("doc")
    final = docs.select(*inner, *row_keys(id, text), packed(text, dictionary).alias("t")).join(spans, ["_k1", "_k2"], "left")
    cut = final.select(*[c for c in final.columns if c not in ("_k1", "_k2", "t", "spans")], cut_spans(dictionary).alias("cut"))
    return cut.select(*back, *[F.col(f"cut.{c}") for c in ("n_bytes", "n_removed", "span_starts", "span_ends", "kept")])
