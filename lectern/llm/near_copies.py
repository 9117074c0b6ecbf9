"""Near copies by exact shingle Jaccard: op6's SimHash links and MinHash bands find candidates, whole shingle sets decide."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import materialise, row_keys, set_aside
from lectern.llm.simhash import components, fingerprints, links

#: 32 bands of 8 minima: a pair at Jaccard 0.8 meets in some band with a chance of 0.997, at 0.9 of 1 - 2e-8, at 0.5 of 0.12.
BANDS, ROWS = 32, 8
#: Members of a block that meet in one task, twice over.
CHUNK = 512
_RNG = np.random.default_rng(42)
_FLIP = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_TIMES = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text of fewer words is one shingle, one without words has none."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[min(size, len(words)) - 1 :].tolist(), strict=True)), np.uint64, n))


def bands(found: np.ndarray) -> list[int]:
    """One 64-bit key for each band of minima."""
    if not len(found):
        return []
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 256):
        np.minimum(least, ((low[at : at + 256, None] ^ _FLIP) * _TIMES).min(axis=0), out=least)
    return [np.uint64(xxhash.xxh64_intdigest(row.tobytes(), k)).astype(np.int64).item() for k, row in enumerate(least.reshape(BANDS, ROWS))]


def sketches(text: str, size: int):
    """(node, bands): what stands for a set of shingles, and its keys."""

    def own(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(t, size) for t in texts]
        node = [np.uint64(xxhash.xxh64_intdigest(s.tobytes())).astype(np.int64).item() for s in found]
        return pd.DataFrame({"node": pd.Series(node, dtype="int64"), "bands": pd.Series([bands(s) for s in found], dtype=object)})

    return F.pandas_udf(own, "node long, bands array<long>")(F.col(f"`{text}`"))


def shingle_bytes(text: str, size: int):
    def own(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, size).tobytes() for t in texts], dtype=object)

    return F.pandas_udf(own, "binary")(F.col(f"`{text}`"))


def spanning(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Of all pairs of sets at ``threshold`` or more, as many as join what they join."""
    size = np.array([len(s) for s in sets], np.int64)
    of = np.repeat(np.arange(len(sets)), size)
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(col, kind="stable")
    holders, first = of[order], np.searchsorted(col[order], np.arange(col.max() + 2))
    up = np.arange(len(sets))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out, at = [], 0
    for i, n in enumerate(size.tolist()):
        mine = col[at : at + n]
        at += n
        same = np.bincount(np.concatenate([holders[first[c] : first[c + 1]] for c in mine]), minlength=len(sets))
        for j in np.flatnonzero(same >= threshold * (n + size - same) - 1e-9).tolist():
            if j > i and (a := top(i)) != (b := top(j)):
                up[b] = a
                out.append((i, j))
    return out


def simhash_candidates(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b) of nodes by their ``prints`` (node, fp), of which a node may have several: those of one fingerprint with their least, and the least of fingerprints that op6's anchors
    link at ``distance`` bits or less."""
    fps = materialise(prints.groupBy("fp").agg(F.min("node").alias("lead")), "near-fingerprints")
    same = prints.join(fps, "fp").filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    lead = lambda c: fps.select(F.col("fp").alias(c), F.col("lead").alias(f"of_{c}"))
    return same.unionByName(links(fps, distance).join(lead("a"), "a").join(lead("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))


def similar(docs: DataFrame, nodes: DataFrame, prints: DataFrame, threshold: float, size: int, text: str, distance: int = 2) -> DataFrame:
    """(a, b): verified links between ``nodes`` (node, bands, _k1, _k2) with their fingerprints ``prints`` (node, fp), which join all candidates that
    reach the threshold.

    Nodes whose fingerprints link, or that share a band, or a chain of these, are one block. Each node's whole set goes to its
    block's task; a block of more than ``CHUNK`` is dealt into chunks, and each two chunks meet in a
    task of their own. All pairs there are compared by their exact Jaccard; out go the links of a
    spanning forest, so a large family makes no pairs."""
    keys = nodes.select("node", F.explode("bands").alias("key"))  # 32 rows of one, which Spark sizes as one: never to be broadcast
    shared = materialise(keys.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n")).filter("n > 1"), "near-shared")  # so that Spark can split the join of a hot band
    banded = keys.hint("merge").join(shared, "key").filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    candidates = simhash_candidates(prints, distance).unionByName(banded).distinct()
    blocks = components(candidates, "near-blocks")
    sizes = blocks.groupBy("root").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("q"))
    members = blocks.join(sizes, "root").join(nodes.drop("bands"), "node")
    sets = docs.select(*row_keys("doc_id", text), F.col(f"`{text}`").alias("t")).join(members, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    sets = sets.select("root", "node", shingle_bytes("t", size).alias("s"), F.pmod(F.xxhash64("node"), "q").cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("o"))
    sets = sets.select("root", "node", "s", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))

    def verified(f: pd.DataFrame) -> pd.DataFrame:
        node = f["node"].to_numpy(np.int64)
        found = np.array(spanning([np.frombuffer(s, np.uint64) for s in f["s"]], threshold), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": node[found[:, 0]], "b": node[found[:, 1]]})

    return sets.groupBy("root", "i", "j").applyInPandas(verified, "a long, b long").distinct()


def one_of_each_similar(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of texts whose sets of ``shingle``-word shingles have a Jaccard
    of ``threshold`` or more, whole and with all its columns: that with the smallest id (null last), of
    several with that id that with the least hash, of equal rows one. Texts without words (null and
    empty ones too) are copies of one another. An empty table gives an empty one; columns keep any name.

    Every link is verified on whole sets. Candidates are what op6 links, SimHash fingerprints of three-word shingles at two bits or less by its
    anchors, and beside them what MinHash bands find (see ``BANDS``), as at 0.8 fingerprints often differ in more bits."""
    base = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = materialise(base.select(*row_keys("doc_id", "text"), "doc_id", sketches("text", shingle).alias("x"), fingerprints("text").alias("fp")).select("_k1", "_k2", "doc_id", "x.*", "fp"), "near-sketches")
    own = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_k1", "_k2")
    nodes = materialise(rows.groupBy("node").agg(F.min(own).alias("best"), F.any_value("bands").alias("bands")), "near-nodes")
    prints = materialise(rows.filter(F.size("bands") > 0).select("node", "fp").distinct(), "near-prints")
    verified = similar(base, nodes.select("node", "bands", "best._k1", "best._k2"), prints, threshold, shingle, "text")
    roots = components(verified, "near-copies")
    classed = nodes.select("node", "best").join(roots, "node", "left").select("best", F.coalesce("root", "node").alias("root"))
    best = classed.groupBy("root").agg(F.min("best").alias("best")).select("best._k1", "best._k2")
    inner, back = set_aside(docs)
    return docs.select(*inner, *row_keys(id, text)).join(best, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select(*back)
