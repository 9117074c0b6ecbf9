"""Approximate nearest neighbours with learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts; a small classifier learns which
part a vector's neighbours are in. Every vector is indexed in its most probable part, and a query
goes to the most probable parts, whose vectors are all scored exactly. The number of parts grows with
the root of the number of vectors; the number of parts asked is the least that reaches the wanted
recall on queries whose nearest are known from a whole scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import materialise


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Weights (n, n): 1 for each direction in which two vectors are among the k nearest."""
    graph = np.zeros((len(x), len(x)), np.float32)
    for at in range(0, len(x), 512):
        score = x[at : at + 512] @ x.T
        rows = np.arange(at, at + len(score))
        score[np.arange(len(score)), rows] = -np.inf
        graph[rows[:, None], np.argpartition(-score, min(k, len(x) - 1) - 1, axis=1)[:, :k]] = 1
    return graph + graph.T


def bisect(graph: np.ndarray, rng: np.random.Generator, rounds: int = 60) -> np.ndarray:
    """Halves the nodes: by the median of the second eigenvector, then by swaps that lessen the cut."""
    n = len(graph)
    root = np.sqrt(np.maximum(graph.sum(axis=1), 1e-9))
    smooth = graph / root[:, None] / root[None, :]
    first, v = root / np.linalg.norm(root), rng.standard_normal(n)
    for _ in range(rounds):
        v = 0.5 * (v + smooth @ v)
        v -= first * (first @ v)
        v /= np.linalg.norm(v) or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[n // 2 :]] = True
    for _ in range(20):
        across = graph @ np.where(side, 1.0, -1.0)
        gain = np.where(side, -across, across)  # links to the other side less those to its own
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b), max(1, n // 50))
        good = [(i, j) for i, j in zip(a[:m], b[:m], strict=True) if gain[i] + gain[j] - 2 * graph[i, j] > 0]
        if not good:
            break
        for i, j in good:
            side[i], side[j] = False, True
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part numbers below ``parts`` (a power of 2); sizes differ by a few at most."""
    rng, out, groups = np.random.default_rng(seed), np.zeros(len(graph), np.int64), [np.arange(len(graph))]
    while len(groups) < parts:
        halves = []
        for g in groups:
            side = bisect(graph[np.ix_(g, g)], rng) if len(g) > 1 else np.zeros(len(g), bool)
            halves += [g[~side], g[side]]
        groups = halves
    for i, g in enumerate(groups):
        out[g] = i
    return out


@dataclass
class Router:
    """A softmax classifier with one hidden layer, over vectors of length 1."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_router(x: np.ndarray, target: np.ndarray, hidden: int = 64, steps: int = 400, rate: float = 0.01, seed: int = 0) -> Router:
    """Full-batch training (Adam) against ``target``, a distribution over parts for each vector."""
    rng = np.random.default_rng(seed)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    p = [rng.standard_normal((x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]), np.zeros(hidden), rng.standard_normal((hidden, target.shape[1])) * np.sqrt(2 / hidden), np.zeros(target.shape[1])]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        h = np.maximum(x @ p[0] + p[1], 0)
        z = h @ p[2] + p[3]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = (z / z.sum(axis=1, keepdims=True) - target) / len(x)
        dh = (d @ p[2].T) * (h > 0)
        for i, g in enumerate([x.T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0)]):
            g = g + 1e-4 * p[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*p)


def usable(vector: Column, length: int) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == length) & finite & F.exists(vector, lambda v: v != 0)


def parts_for(n: int, sample: int) -> int:
    """The number of parts for ``n`` vectors: a power of 2 near a sixteenth of their root, from 16 up to
    an eighth of the sample that they're learnt from."""
    return int(2 ** round(np.log2(np.clip(np.sqrt(max(n, 1)) / 16, 16, max(16, sample // 8)))))


def best_of(q: np.ndarray, qid: np.ndarray, r: np.ndarray, rid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, row of ``r``, score) of the ``k`` largest inner products of each query with vectors
    other than its own, in order; sums in component order, ties to smaller ids."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    longest = np.linalg.norm(r, axis=1).max() if len(r) else 0.0
    for at in range(0, len(q) if len(r) else 0, 256):
        part = q[at : at + 256]
        s = part @ r.T
        s[qid[at : at + 256, None] == rid[None, :]] = -np.inf
        worst = np.partition(s, len(r) - k, axis=1)[:, len(r) - k] if len(r) > k else np.full(len(part), -np.inf)
        i, j = np.nonzero((s >= (worst - 1e-12 * np.linalg.norm(part, axis=1) * longest)[:, None]) & (s > -np.inf))
        exact = np.zeros(len(i))
        for d in range(q.shape[1]):
            exact += part[i, d] * r[j, d]
        order = np.lexsort((rid[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(i)) + 1)) if len(i) else np.zeros(0, int)
        best = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i)))) < k
        out.append((at + i[best], j[best], exact[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def true_parts(index: DataFrame, tests: pd.DataFrame, k: int) -> pd.DataFrame:
    """(q, part) for the ``k`` nearest of each of the few ``tests`` (id, v) among all rows of ``index``: one
    scan, of which each task gives ``k`` rows a query."""
    q, qid = np.array(tests["v"].tolist()), tests["id"].to_numpy()

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame({"q": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "part": np.zeros(0, np.int32), "score": np.zeros(0)})
        for f in frames:
            if len(f):
                i, j, score = best_of(q, qid, np.array(f["v"].tolist()), f["id"].to_numpy(), k)
                held = pd.concat([held, pd.DataFrame({"q": i, "id": f["id"].to_numpy()[j], "part": f["part"].to_numpy()[j], "score": score})])
                held = held.sort_values(["q", "score", "id"], ascending=[True, False, True]).groupby("q").head(k)
        yield held

    found = index.select("id", "part", "v").mapInPandas(scan, "q long, id long, part int, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("q", "part").toPandas()  # k rows for each test


def probes_needed(probabilities: np.ndarray, truth: pd.DataFrame, recall: float) -> int:
    """The least number of most probable parts in which a share of ``recall`` of the true nearest lie."""
    place = np.argsort(np.argsort(-probabilities, axis=1, kind="stable"), axis=1, kind="stable")
    ranks = np.sort(place[truth["q"].to_numpy(), truth["part"].to_numpy()])
    return int(ranks[max(0, int(np.ceil(recall * len(ranks))) - 1)]) + 1 if len(ranks) else 1


def nearest(
    vectors: DataFrame, k: int = 20, is_query: Column | None = None, recall: float = 0.95, parts: int | None = None, probes: int | None = None, sample: int = 4096,
    tests: int = 256, graph_k: int = 10, block_rows: int = 4096, query_rows: int = 4096, seed: int = 0, id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found by inner product of each row for which
    ``is_query`` holds (all rows by default), itself left out.

    The index is fitted on at most ``sample`` vectors, chosen by hash of their ids, and holds every
    vector, each in the most probable of ``parts`` parts (by default as many as ``parts_for`` gives). A
    query is scored against all vectors of its ``probes`` most probable parts, and of more in order of
    probability until these hold k others; nothing is capped. By default ``probes`` is measured: the
    least number at which ``tests`` queries, chosen by hash, find a share of ``recall`` of their true
    nearest among all vectors. Scores are sums in double precision in component order; ties go to
    smaller ids.

    A part of more than ``block_rows`` vectors is dealt into blocks, and the queries that come to
    it into chunks of ``query_rows``, so no task holds a part whole, however large it is. A vector
    travels once for each chunk of its own part, not of all queries.

    Vectors that are null, zero, of another length than most, or hold null or non-finite components
    take no part, nor do rows with null ids; of several rows with one id the least vector counts. Equal
    vectors under several ids are candidates each. Extra columns are left out; an empty table gives an empty one.
    """
    rows = vectors.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), F.coalesce(is_query if is_query is not None else F.lit(True), F.lit(False)).alias("asks")).filter("id is not null and v is not null")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).head()
    none = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return none
    rows = materialise(rows.filter(usable(F.col("v"), common["n"])).groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")), "ann-vectors")
    parts = parts or parts_for(rows.count(), sample)
    chosen = rows.select("id", "v").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(min(sample, max(2048, 8 * parts))).select("v").toPandas()
    if not len(chosen):
        return none
    x = np.array(chosen["v"].tolist())
    while parts > 1 and len(x) < 4 * parts:
        parts //= 2
    graph = neighbour_graph(x / np.linalg.norm(x, axis=1, keepdims=True), graph_k) if len(x) > 1 else np.zeros((1, 1), np.float32)
    hot = np.eye(parts)[balanced_parts(graph, parts, seed)]
    near = graph @ hot + hot
    router = fit_router(x, near / near.sum(axis=1, keepdims=True), seed=seed)

    def part_of(vs: pd.Series) -> pd.Series:
        return pd.Series(router.probabilities(np.array(vs.tolist())).argmax(axis=1).astype(np.int32)) if len(vs) else pd.Series([], dtype="int32")

    index = materialise(rows.withColumn("part", F.pandas_udf(part_of, "int")("v")), "ann-index")
    if probes is None:
        known = index.filter("asks").orderBy(F.xxhash64("id", F.lit(seed + 1)), "id").limit(tests).select("id", "v").toPandas()
        probes = probes_needed(router.probabilities(np.array(known["v"].tolist())), true_parts(index, known, k), recall) if len(known) else 1
    held = np.zeros(parts, np.int64)
    for r in index.groupBy("part").count().collect():  # a row for each part
        held[r["part"]] = r["count"]

    def route(vs: pd.Series) -> pd.Series:
        if not len(vs):
            return pd.Series([], dtype=object)
        order = np.argsort(-router.probabilities(np.array(vs.tolist())), axis=1, kind="stable")
        needed = np.maximum(probes, (np.cumsum(held[order], axis=1) < k + 1).sum(axis=1) + 1)
        return pd.Series([[int(p) for p in o[:n] if held[p]] for o, n in zip(order, needed, strict=True)])

    routed = materialise(index.filter("asks").select("id", "v", F.pandas_udf(route, "array<int>")("v").alias("to")), "ann-routed")
    asked = np.zeros(parts, np.int64)
    for r in routed.select(F.explode("to").alias("part")).groupBy("part").count().collect():  # a row for each part
        asked[r["part"]] = r["count"]
    blocks, chunks = np.maximum(1, -(-held // block_rows)), np.maximum(1, -(-asked // query_rows))
    of: Callable[[np.ndarray], Column] = lambda sizes: F.element_at(F.array(*[F.lit(int(n)) for n in sizes]), F.col("part") + 1)
    base = index.filter(of(asked) > 0).select("part", F.pmod(F.xxhash64("id"), of(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), of(chunks) - 1)).alias("chunk"), "id", "v")
    queries = routed.select("id", "v", F.explode("to").alias("part"))
    queries = queries.select("part", F.explode(F.sequence(F.lit(0), of(blocks) - 1)).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), of(chunks)).cast("int").alias("chunk"), "id", "v")

    def score(queries: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(others):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        i, j, exact = best_of(np.array(queries["v"].tolist()), queries["id"].to_numpy(), np.array(others["v"].tolist()), others["id"].to_numpy(), k)
        return pd.DataFrame({"query_id": queries["id"].to_numpy()[i], "vec_id": others["id"].to_numpy()[j], "score": exact})

    key = ["part", "block", "chunk"]
    found = queries.groupBy(*key).cogroup(base.groupBy(*key)).applyInPandas(score, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
