"""Near copies against all pairs by brute force."""

import random

from lectern.llm import near_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def first_of_each(data, threshold=0.8):
    s, up = [sets(r[1]) for r in data], list(range(len(data)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            if s[i] == s[j] or len(s[i] & s[j]) >= threshold * len(s[i] | s[j]) - 1e-9:
                up[top(i)] = top(j)
    least = {}
    for i, r in enumerate(data):
        least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return set(least.values())


def planted():
    """Families of a text of 120 words and copies with one to five words changed, short texts, empty ones and copies."""
    rng = random.Random(3)
    own = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    data = []
    for _ in range(12):
        base = own(120)
        data.append(" ".join(base))
        for changed in range(1, 6):
            t = list(base)
            for at in rng.sample(range(120), changed):
                t[at] = own(1)[0]
            data.append(" ".join(t))
    data += ["", None, "one two", "ONE  two", "one three"] + [" ".join(own(60)) for _ in range(20)]
    rng.shuffle(data)
    return [(i, t, "en", "s1", len(t or "")) for i, t in enumerate(data)]


def test_stage_drops_planted_near_copies(spark):
    import corpus_pipeline

    data = planted()
    want = first_of_each(data)
    got = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(data, SCHEMA), "").collect()]
    assert sorted(got) == sorted(want) and len(want) < len(data) - 25


def test_simhash_links_are_candidates(spark):
    """Texts that share no band, but are op6's near duplicates; one that shares a fingerprint alone isn't linked."""
    from lectern.llm.common import row_keys
    from lectern.llm.simhash import fingerprint

    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    texts = [" ".join(base)] + [" ".join(base[:at] + ["other"] + base[at + 1 :]) for at in range(50, 2950, 100)] + ["quite another text of some words"]
    fps = [fingerprint(t) for t in texts[:-1]] + [fingerprint(texts[0])]
    near = [i for i in range(len(texts) - 1) if ((fps[i] ^ fps[0]) & (2**64 - 1)).bit_count() <= 2]
    keep = [*near, len(texts) - 1]
    docs = spark.createDataFrame([(i, texts[i]) for i in keep], "doc_id long, text string")
    nodes = docs.selectExpr("doc_id", "text", "doc_id node", "array(doc_id) bands").select("node", "bands", *row_keys("doc_id", "text"))
    prints = spark.createDataFrame([(i, fps[i]) for i in keep], "node long, fp long")
    joined = {n for r in near_copies.similar(docs, nodes, prints, 0.8, 5, "text").collect() for n in r}
    assert len(near) > 2 and joined == set(near)


def test_large_block_is_dealt_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "CHUNK", 4)
    data = planted()
    got = {r["doc_id"] for r in near_copies.one_of_each_similar(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == first_of_each(data)
    assert near_copies.one_of_each_similar(spark.createDataFrame([], SCHEMA)).count() == 0


def test_banded_keys_are_not_broadcast(spark, monkeypatch):
    """Spark takes the exploded keys for a row each; here they are the side that it sizes lower."""
    from pyspark.sql import functions as F

    seen, materialise = [], near_copies.materialise

    def wide(df, name):  # shared bands with a wide column, so that Spark sizes them above the keys
        return materialise(df, name).withColumn("pad", F.sequence(F.lit(0), F.lit(3))) if name == "near-shared" else materialise(df, name)

    monkeypatch.setattr(near_copies, "materialise", wide)
    monkeypatch.setattr(near_copies, "components", lambda edges, name: seen.append(edges) or edges.select(F.col("a").alias("node"), F.col("b").alias("root")))
    nodes = spark.range(40).select(F.col("id").alias("node"), F.array((F.col("id") / 2).cast("long")).alias("bands"), F.col("id").alias("_k1"), F.col("id").alias("_k2"))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    near_copies.similar(docs, nodes, spark.range(40).select(F.col("id").alias("node"), F.col("id").alias("fp")), 0.8, 5, "text")
    plan = seen[0]._jdf.queryExecution().sparkPlan().toString()
    assert {tuple(r) for r in seen[0].filter("b % 2 = 1 and a = b - 1").collect()} >= {(i, i + 1) for i in range(0, 40, 2)}
    banded = [line for line in plan.splitlines() if "Join [key" in line or "Join [coalesce(key" in line]
    assert len(banded) == 1 and "SortMergeJoin" in banded[0], plan


def test_anchor_copies_are_not_broadcast(spark, tmp_path):
    """Spark sizes the copies of a fingerprint, some thirty, as a row; they meet their homes by an exchange however small it takes them for."""
    from pyspark.sql import functions as F

    from lectern.llm.simhash import links

    spark.range(300).select(F.xxhash64("id").alias("fp")).union(spark.range(300).select((F.xxhash64("id").bitwiseXOR(F.lit(5))).alias("fp"))).distinct().write.parquet(f"{tmp_path}/fps")
    found = links(spark.read.parquet(f"{tmp_path}/fps"))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    assert found.count() == 300
