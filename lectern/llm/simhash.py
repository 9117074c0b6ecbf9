"""SimHash near-duplicates by anchor-point covering, and connected components of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import materialise, replacing, row_keys, set_aside

BITS = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        ones += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(text: str, shingle: int = 3):
    def own(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return F.pandas_udf(own, T.LongType())(F.col(f"`{text}`"))


class Covering:
    """The anchors of one piece of a fingerprint: a Hamming code on the most bits it fits, and the
    bits left over as they are. Every value is within 1 of an anchor (the covering radius)."""

    def __init__(self, first: int, bits: int):
        self.first, self.bits, self.r = first, bits, int(np.log2(bits + 1))
        self.n = 2**self.r - 1
        self.parity = np.array([sum(1 << (i - 1) for i in range(1, self.n + 1) if i >> k & 1) for k in range(self.r)], np.uint64)
        one = lambda i: np.uint64(1 << (i - 1)) if i else np.uint64(0)
        self.flip = np.array([one(s) for s in range(self.n + 1)], np.uint64)
        #: By syndrome, the pairs of bits whose flips lead to another codeword.
        self.pairs = np.zeros((self.n + 1, (self.n - 1) // 2), np.uint64)
        for s in range(1, self.n + 1):
            self.pairs[s] = [one(i) | one(i ^ s) for i in range(1, self.n + 1) if i != s and i < i ^ s]

    def piece(self, fp: np.ndarray) -> np.ndarray:
        return (fp.view(np.uint64) >> np.uint64(self.first)) & np.uint64((1 << self.bits) - 1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        syndrome = np.zeros(len(x), np.int64)
        for k, mask in enumerate(self.parity):
            syndrome |= (np.bitwise_count(x & mask).astype(np.int64) & 1) << k
        return x ^ self.flip[syndrome], syndrome

    def within(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of all anchors within the covering radius plus 1 of each value."""
        home, syndrome = self.nearest(x)
        rows, anchors = [np.arange(len(x))], [home]
        odd = np.flatnonzero(syndrome)
        rows.append(np.repeat(odd, self.pairs.shape[1]))
        anchors.append((x[odd, None] ^ self.pairs[syndrome[odd]]).ravel())
        for free in range(self.n, self.bits):
            rows.append(np.arange(len(x)))
            anchors.append(home ^ np.uint64(1 << free))
        return np.concatenate(rows), np.concatenate(anchors)


def coverings(distance: int) -> list[Covering]:
    """Fingerprints at ``distance`` or less differ by 1 at most in one of distance // 2 + 1 pieces."""
    m = distance // 2 + 1
    at = [BITS * i // m for i in range(m + 1)]
    return [Covering(a, b - a) for a, b in zip(at, at[1:], strict=False)]


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at ``distance`` bits or less.

    ``fps`` has one row for each fingerprint (column ``fp``). Each is at home at the nearest anchor
    of each piece, and is copied to all anchors within the covering radius plus the piece's share of
    the distance; so each pair meets where one of them is at home. A fingerprint has a few dozen
    copies, however many fingerprints there are, and at most 2,080 links for distance 2."""

    def homes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy(np.int64)
            for i, c in enumerate(coverings(distance)):
                yield pd.DataFrame({"piece": np.int32(i), "anchor": c.nearest(c.piece(fp))[0].view(np.int64), "a": fp})

    def copies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            whole = f["fp"].to_numpy(np.int64)
            for at in range(0, len(whole), 4096):
                fp = whole[at : at + 4096]
                for i, c in enumerate(coverings(distance)):
                    rows, anchors = c.within(c.piece(fp))
                    yield pd.DataFrame({"piece": np.int32(i), "anchor": anchors.view(np.int64), "b": fp[rows]})

    home = fps.select("fp").mapInPandas(homes, "piece int, anchor long, a long")
    copy = fps.select("fp").mapInPandas(copies, "piece int, anchor long, b long")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    met = home.join(copy.hint("merge"), ["piece", "anchor"]).filter(near)  # Spark sizes the copies as if they were a row each, and would broadcast them
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): nodes have one root if and only if a chain of
    edges joins them.

    Each round points every node at its least neighbour, in an order that is dealt anew each
    round so that chains shrink too, follows the pointer once more, and contracts the edges. The edges
    left fall by a constant factor a round. Each round's table ends its lineage."""
    edges = materialise(edges.select("a", "b"), f"{name}-edges")
    rounds: list[DataFrame] = []
    while edges.head(1):
        order = lambda c, k=len(rounds): F.struct(F.xxhash64(F.lit(k), c).alias("o"), F.col(c).alias("v"))
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(order("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", order("a"))["v"].alias("up"))
        least = materialise(least, f"{name}-up")
        again = least.select(F.col("node").alias("up"), F.col("up").alias("root"))
        roots = materialise(least.join(again, "up").select("node", "root"), f"{name}-roots")
        rounds.append(roots)
        ra, rb = roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = edges.join(ra, "a").join(rb, "b").filter(F.col("ra") != F.col("rb"))
        edges = materialise(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{name}-edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0]
    for later in rounds[1:]:
        out = out.join(later.select(F.col("node").alias("root"), F.col("root").alias("then")), "root", "left").select("node", F.coalesce("then", "root").alias("root"))
    return out


def near_duplicates(docs: DataFrame, distance: int = 2, shingle: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text (names below are replaced), ``fingerprint`` (long),
    ``component_id``: the smallest id reachable over links of ``distance`` bits or less, and
    ``component_root``, a fingerprint that stands for the component.

    Null and empty texts have fingerprint 0 and link like any other. Rows with one fingerprint
    are one node, so copies cost a row each and no pairs. Null ids are never a component's id
    unless all of its ids are null. Equal rows get equal results. Texts are read once and don't move.
    An empty table gives an empty one; any other column keeps its name.
    """
    base = replacing(docs, *[n for n in ("fingerprint", "component_id", "component_root") if n not in (id, text)])
    inner, back = set_aside(base, text, own_id=id)
    rows = materialise(docs.select(*inner, fingerprints(text, shingle).alias("fingerprint")), "simhash")
    fps = materialise(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("own_id").alias("least")), "simhash-distinct")
    roots = components(links(fps, distance), "simhash")
    classed = materialise(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-classed")
    heads = materialise(classed.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-heads")  # apart, so that Spark can split the join of a giant component
    classes = materialise(classed.join(heads, "root").select(F.col("fp").alias("fingerprint"), "component_id", F.col("root").alias("component_root")), "simhash-classes")
    return rows.join(classes, "fingerprint").select(*back, "fingerprint", "component_id", "component_root")


def one_of_each(docs: DataFrame, distance: int = 2, shingle: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, whole and with all its columns: that with the smallest id
    (null last), of several with that id that with the least hash, of equal rows one. Null and empty texts
    have fingerprint 0; an empty table gives an empty one; columns keep any name."""
    rows = near_duplicates(docs.select(*row_keys(id, text), F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")), distance, shingle, "id", "text")
    own = F.struct(F.col("id").isNull().alias("n"), "id", "_k1", "_k2")
    best = rows.groupBy("component_root").agg(F.min(own).alias("best")).select("best._k1", "best._k2")
    inner, back = set_aside(docs)
    return docs.select(*inner, *row_keys(id, text)).join(best, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select(*back)
