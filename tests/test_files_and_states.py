"""Image headers, files that stand in for one another, states, and orders and runs dealt by ranges."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import audits, publish, upkeep
from lectern import storage
from lectern.sources import corpus


def webp(kind, rest):
    return (b"RIFF\0\0\0\0WEBP" + kind + b"\0\0\0\0" + rest).ljust(64, b"\0")


SOF = b"\xff\xc0\0\x11\x08" + struct.pack(">HH", 5, 7) + b"\x03" * 12
IMAGES = [
    (webp(b"VP8X", b"\0\0\0\0" + (319).to_bytes(3, "little") + (239).to_bytes(3, "little")), (320, 240)),
    (webp(b"VP8L", b"\x2f" + ((99) | (49 << 14)).to_bytes(4, "little")), (100, 50)),
    (webp(b"VP8 ", b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 9, 4)), (9, 4)),
    (webp(b"VP8 ", b"\0\0\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 9, 4)), (9, 4)),  # the start code stands later
    (webp(b"VP8 ", b"\0" * 30), (None, None)),  # no start code
    (webp(b"VP8 ", b"\0" * 24 + b"\x9d\x01\x2a" + struct.pack("<HH", 9, 4)), (None, None)),  # too late
    (b"\xff\xd8" + SOF, (7, 5)),
    (b"\xff\xd8\xff\xff\xff" + SOF, (7, 5)),  # fill bytes
    (b"\xff\xd8\0" + SOF, (7, 5)),  # a pad byte
    (b"\xff\xd8\xff\xd0\xff\xd7" + SOF, (7, 5)),  # restarts
    (b"\xff\xd8\xff\xe0\0\x04ab\xff\xc4\0\x03a" + SOF, (7, 5)),  # segments and a table
    (b"\xff\xd8\xff\xe0\xff\xff", (None, None)),
    (b"GIF89a" + struct.pack("<HH", 3, 2), (3, 2)),
    (b"\0\0\0\x1cftypavif" + b"\0" * 12 + b"ispe\0\0\0\0" + struct.pack(">II", 640, 480), (640, 480)),
    (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 11, 12), (11, 12)),
    (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 0, 12), (None, None)),
    (b"", (None, None)), (None, (None, None)), (b"plain text that is no image", (None, None)),
]


@pytest.mark.parametrize("content,size", IMAGES)
def test_image_header(content, size):
    assert corpus.size_of_image(content) == size


def test_image_files(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(IMAGES[9][0] + b"\0" * 100_000)
    (tmp_path / "b é %41.jpg").write_bytes(IMAGES[9][0])
    with open(tmp_path / "c.jpg", "wb") as f:  # a gigabyte, of which the head alone is read
        f.write(IMAGES[9][0])
        f.truncate(1 << 30)
    (tmp_path / "late.jpg").write_bytes(b"\xff\xd8" + b"\0" * 70_000 + IMAGES[9][0][2:])
    got = {r["path"].rpartition("/")[2]: (r["width"], r["height"]) for r in corpus.image_sizes(spark, str(tmp_path)).collect()}
    assert got == {"a.jpg": (7, 5), "b é %41.jpg": (7, 5), "c.jpg": (7, 5), "late.jpg": (None, None)}


def test_first_overrides(spark, tmp_path):
    """Whichever file parses first gives the overrides, whatever it holds; the map is the member ``overrides``."""
    layouts = corpus.OVERRIDE_FILES["svizzera"]
    for layout in layouts:
        (tmp_path / layout).parent.mkdir()
    read = lambda: sorted(tuple(r)[1:] for r in corpus.first_overrides(corpus.override_files(spark, str(tmp_path), layouts)).collect())
    assert read() == []
    (tmp_path / layouts[1]).write_text(json.dumps({"version": 1, "overrides": {"a": "https://w/a/", "b": "no", "c": "http://w/c", "d": 4, "e": None}}, indent=1))
    assert read() == [("a", "https://w/a/"), ("c", "http://w/c")]
    (tmp_path / layouts[0]).write_text('{"overrides": {"z": "http://w/z"}')
    assert read() == [("a", "https://w/a/"), ("c", "http://w/c")], "a file that doesn't parse is passed over"
    for held in ('{"a": "https://w/a/"}', "[]", "null", '{"overrides": 5}', '{"overrides": {}}'):
        (tmp_path / layouts[0]).write_text(held)
        assert read() == [], "a file that parses is the one, even without overrides"
    assert corpus.first_overrides(corpus.override_files(spark, str(tmp_path), corpus.OVERRIDE_FILES["frontaliere"])).count() == 0


STATE = "version int, runCounter long, currentQuota int, lastTune string"


def test_states_are_saved_and_counted(spark, tmp_path):
    path = str(tmp_path / "state")
    state = upkeep.quota_states(spark.createDataFrame([(None,)], "value string"))
    assert publish.replace_json(state, path)
    for n in (1, 2, 3):
        state = upkeep.counted(storage.current(spark, path, STATE))
        assert publish.replace_json(state, path)
        assert storage.current(spark, path, STATE).head()["runCounter"] == n
    before = sorted(p.name for p in (tmp_path / "state").iterdir())
    assert not publish.replace_json(spark.range(1).select(F.raise_error(F.lit("x")).alias("x")), path)
    assert storage.current(spark, path, STATE).head()["runCounter"] == 3 and sorted(p.name for p in (tmp_path / "state").iterdir()) == before
    assert upkeep.counted(storage.current(spark, path, STATE), succeeded=False).head()["runCounter"] == 3


@pytest.mark.parametrize("step", ["touch", "remove", "names"])
def test_a_commit_that_dies_leaves_whole_rows(spark, tmp_path, monkeypatch, step):
    path, seen = str(tmp_path / "t"), []
    for n in range(3):
        storage.commit(spark.range(n, n + 2), path)

    def dies(self, *args):
        # what readers find at the moment of the failure
        with monkeypatch.context() as m:
            m.setattr(storage.Files, step, whole)
            seen.append(sorted(r["id"] for r in storage.current(spark, path, "id long").collect()))
        raise RuntimeError("killed")

    whole = getattr(storage.Files, step)
    monkeypatch.setattr(storage.Files, step, dies)
    with pytest.raises(RuntimeError):
        storage.commit(spark.range(7, 9), path)
    monkeypatch.undo()
    left = sorted(r["id"] for r in storage.current(spark, path, "id long").collect())
    assert set(map(tuple, seen)) <= {(2, 3), (7, 8)} and left in ([2, 3], [7, 8])
    storage.commit(spark.range(1), path)
    assert storage.current(spark, path, "id long").count() == 1 and len(storage.versions(spark, path)) <= 3


def test_changed_rows_alone_are_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    texts = {f"p{i}": f"text {i}" for i in range(60)}
    rows = lambda: spark.createDataFrame(list(texts.items()), "path string, content string")
    held = lambda: {r["path"]: r["content"] for r in storage.held_rows(spark, path, storage.HELD).collect()}
    folders = lambda: sorted(p for p in (tmp_path / "t").glob("rows-*/bucket=*"))
    assert storage.write_changed(rows(), path, 8).count() == 60 and held() == texts
    assert storage.write_changed(rows(), path, 8).count() == 0
    first = folders()
    texts["p7"] = "other"
    assert [tuple(r) for r in storage.write_changed(rows(), path, 8).collect()] == [("p7", "changed")] and held() == texts
    assert len(folders()) == len(first) + 1, "one changed row rewrites one bucket"
    before = dict(texts)
    del texts["p3"]
    texts["new"] = "n"
    with monkeypatch.context() as m:
        m.setattr(storage.Files, "touch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            storage.write_changed(rows(), path, 8)
    assert held() == before, "a run that dies leaves the rows of the one before"
    assert sorted(tuple(r) for r in storage.write_changed(rows(), path, 8).collect()) == [("new", "new"), ("p3", "removed")] and held() == texts
    assert len(storage.sweep(spark, path)) == 1 and held() == texts, "the folder of the run that died"


def test_catalog_grows_by_what_it_lacks(spark, tmp_path):
    path = str(tmp_path / "catalog")
    files = spark.createDataFrame([("a/blue-lake.webp",), ("a/x1.webp",), ("b.png",)], "path string")
    upkeep.append_entries(upkeep.catalog_entries(files, files.limit(0)), path)
    assert upkeep.catalog_entries(files, spark.read.parquet(path)).count() == 0 and spark.read.parquet(path).count() == 1


def test_only_changed_descriptions_are_written(spark):
    now = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None), ("d", "x")], "id string, description string")
    wanted = spark.createDataFrame([("a", "y"), ("b", "x"), ("c", "z"), ("d", "y")], "id string, description string")
    verdicts = spark.createDataFrame([("a", "ok"), ("b", "ok"), ("c", "ok"), ("d", "not registered")], "id string, verdict string")
    assert sorted(map(tuple, upkeep.changed_descriptions(now, wanted, verdicts).collect())) == [("a", "y"), ("c", "z")]


def test_events_without_dates_are_refused(spark):
    events = spark.createDataFrame([("a", None), ("b", "")], "id string, date string")
    assert audits.publishable(events.union(spark.createDataFrame([("c", "2024-01-01")], events.schema)), "date").count() == 3
    with pytest.raises(Exception, match="refused"):
        audits.publishable(events, "date").collect()


@pytest.mark.parametrize("seed", range(4))
def test_runs_over_ranges(spark, seed):
    import random

    rng = random.Random(seed)
    rows = [(k, i, None if rng.random() < 0.05 else rng.random() < 0.9) for k in ("a", "b") for i in range(rng.randint(1, 300))] + [("c", i, True) for i in range(150)] + [("d", 1, False)]
    best = {}
    for k, _, failed in rows:
        run = best.setdefault(k, [0, 0])
        run[1] = run[1] + 1 if failed else 0
        run[0] = max(run)
    rng.shuffle(rows)
    got = upkeep.longest_runs(spark.createDataFrame(rows, "k string, i long, failed boolean"), "k", "i", "failed", [7, 100, 1_000_000][seed % 3]).collect()
    assert {r["k"]: r["longest"] for r in got} == {k: v[0] for k, v in best.items()}
    assert upkeep.longest_runs(spark.createDataFrame([], "k string, i long, failed boolean"), "k", "i", "failed").count() == 0


def test_preferred_order_with_nulls(spark):
    df = spark.createDataFrame([("x", 1), ("b", 2), (None, 3), ("a", 4), ("b", 5)], "name string, i long")
    got = publish.preferred_order(df, ["a", "b"], "name", "i").orderBy("position").collect()
    assert [r["i"] for r in got] == [4, 2, 5, 1, 3] and [r["position"] for r in got] == [1, 2, 3, 4, 5]


def test_meta_escapes(spark):
    got = spark.range(1).select(T.meta_unescaped(F.lit("a\\'b\\\\'c\\\"d\\ne")).alias("x")).head()["x"]
    assert got == "a'b\\'c\"d\\ne"


def article_tree(root):
    """Files that Spark's readers take and others that they pass over, at several depths."""
    text = lambda k: f"export default {{\n  'blog.article.{k}.body1': 'uno {k}',\n  'blog.article.{k}.body2': `due é😀`,\n}};\n"
    names = ["s/it/a.ts", "s/it/b c%20d.ts", "s/de/a.ts", "t/x/y/z/deep.ts", "s/it/.hidden.ts", "s/it/_left.ts", "s/it/_k=1.ts", "_tmp/it/a.ts", ".git/it/a.ts", "s/it/note.txt", "top.ts"]
    for k, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text(f"d{k}"), encoding="utf-8")
    (root / "s/it/empty.ts").write_text("")
    (root / "empty/folder").mkdir(parents=True)


def test_article_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver's plan names none of the files; what is found is what Spark's own reader finds, of many tasks too."""
    article_tree(tmp_path)
    want = {(r["section"], r["locale"], r["article_id"], r["field"], r["value"]) for r in plain_bodies(spark, str(tmp_path))}
    for files in (2048, 2):
        monkeypatch.setattr(corpus, "FILES_A_TASK", files, raising=False)
        bodies = corpus.article_bodies(spark, str(tmp_path))
        assert not [f for f in bodies.inputFiles() if f.endswith(".ts")]
        got = bodies.collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want) == 12
    assert {tuple(r)[2:] for r in corpus.article_bodies(spark, str(tmp_path / "s/it/a.ts")).collect()} == {("d0", "body1", "uno d0"), ("d0", "body2", "due é😀")}
    assert corpus.article_bodies(spark, str(tmp_path / "empty")).collect() == []
    with pytest.raises(FileNotFoundError):
        corpus.article_bodies(spark, str(tmp_path / "nowhere"))


def plain_bodies(spark, path):
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.ts").select("value", F.col("_metadata.file_path").alias("path"))
    steps = F.split("path", "/")
    each = files.select(F.element_at(steps, -3).alias("section"), F.element_at(steps, -2).alias("locale"), F.explode(F.expr("regexp_extract_all(value, \"(?s)'blog.article.d[0-9]+.body[12]': .*?[^,]*\", 0)")).alias("e"))
    return each.select("section", "locale", F.regexp_extract("e", "article[.](d[0-9]+)[.]", 1).alias("article_id"), F.regexp_extract("e", "(body[12])", 1).alias("field"), F.regexp_extract("e", ": .(.*).$", 1).alias("value")).collect()


def test_article_files_where_only_spark_reads(spark, tmp_path):
    """A file system that pyarrow doesn't open."""
    article_tree(tmp_path)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.arts.link./in", f"file://{tmp_path}")
    (tmp_path / "top.ts").unlink()  # its section and locale are the path's own
    want = corpus.article_bodies(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, corpus.article_bodies(spark, "viewfs://arts/in").collect())) == sorted(map(tuple, want)) and len(want) == 10
