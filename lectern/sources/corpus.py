"""Readers of article corpora and logs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lectern.functions.numeric import trend_score
from lectern.functions.predicates import articleable
from lectern.functions.text import trimmed, ts_unescaped
from lectern.operators.dedup import keep_first
from lectern.storage import Files, written

#: Files that one task reads. Their number is known by then, so tasks grow with it and each has few names.
FILES_A_TASK = 2048


def visible(name: str) -> bool:
    """Whether Spark's readers take a file or folder of this name."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def listed_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame | None:
    """(path) of the files at any depth under ``path`` whose names end so, those that Spark's readers pass over left out. Tasks list
    the folders, level by level, and write what they find, so the driver holds no names; one folder is listed by one task. None where
    pyarrow doesn't open the file system: it does local ones, HDFS, S3 and GCS."""
    files = Files(spark, path)
    root = files.fs.makeQualified(files.path_of(path)).toString()
    try:
        system, inside = opened(root)
    except (ValueError, OSError, NotImplementedError):
        return None
    if not files.fs.exists(files.path_of(root)):
        raise FileNotFoundError(root)

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for folder in f["path"]:
                system, inside = opened(folder)
                found = system.get_file_info(fs.FileSelector(inside))
                for at in range(0, len(found), 8192):
                    own = [(f"{folder}/{x.base_name}", x.type == fs.FileType.Directory) for x in found[at : at + 8192] if visible(x.base_name) and (x.type == fs.FileType.Directory or x.base_name.endswith(suffix))]
                    yield pd.DataFrame(own, columns=["path", "folder"]).astype({"path": object, "folder": bool})

    if system.get_file_info(inside).type == fs.FileType.File:
        return spark.createDataFrame([(root,)], "path string")
    folders, n, out = spark.createDataFrame([(root,)], "path string"), 1, None
    while n:
        level = written(folders.repartition(min(n, 4096)).mapInPandas(listed, "path string, folder boolean"), "listed")
        own, folders = level.filter("not folder").select("path"), level.filter("folder").select("path")
        out, n = own if out is None else out.unionByName(own), folders.count()
    return out


def whole_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(path, value) of the files under ``path`` whose names end so, listed and read by tasks. On a file system that pyarrow doesn't open
    Spark reads them, and the driver holds their names."""
    files = listed_files(spark, path, suffix)
    if files is None:
        return spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}").select(F.col("_metadata.file_path").alias("path"), "value")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            own, held = [], 0
            for name in f["path"]:
                system, inside = opened(name)
                with system.open_input_file(inside) as file:
                    own.append((name, file.read()))
                held += len(own[-1][1])
                if held > 1 << 22:
                    yield pd.DataFrame(own, columns=["path", "value"])
                    own, held = [], 0
            yield pd.DataFrame(own, columns=["path", "value"], dtype=object)

    tasks = max(1, -(-files.count() // FILES_A_TASK))
    return files.repartition(tasks, "path").mapInPandas(read, "path string, value binary").select("path", F.col("value").cast("string").alias("value"))


def article_bodies(spark: SparkSession, path: str) -> DataFrame:
    """(section, locale, article_id, field, value) of files <section>/<locale>/<id>.ts, whose
    values stand in single quotes or back-ticks. Tasks list and read the files."""
    files = whole_files(spark, path, ".ts")
    # Possessive loops: others go as deep as a value is long.
    entry = r"""'blog\.article\.([^']+)\.(\w+)'\s*:\s*(?:'((?:[^'\\]++|\\.)*+)'|`((?:[^`\\]++|\\.)*+)`)"""
    found = files.select("path", F.explode(F.regexp_extract_all("value", F.lit(f"(?s)({entry})"), F.lit(1))).alias("e"))
    # An entry's key ends before its value, which is the rest but for two marks, so long values are matched once.
    key = lambda i: F.regexp_extract("e", r"^'blog\.article\.([^']+)\.(\w+)'\s*:\s*", i)
    named = found.select("path", "e", key(1).alias("article_id"), key(2).alias("field"), F.char_length(key(0)).alias("n"))
    steps = F.split("path", "/")
    return named.select(F.element_at(steps, -3).alias("section"), F.element_at(steps, -2).alias("locale"), "article_id", "field", ts_unescaped(F.substring("e", F.col("n") + 2, F.char_length("e") - F.col("n") - 2)).alias("value"))


def faq_items(bodies: DataFrame) -> DataFrame:
    """The questions and answers of ``faq`` fields."""
    items = F.from_json("value", "array<struct<q:string,a:string>>")
    return bodies.filter("field = 'faq'").select("section", "locale", "article_id", F.posexplode(items).alias("position", "item")).select("section", "locale", "article_id", "position", "item.q", "item.a")


#: Where the canonical overrides of a section may stand, in the order in which they're tried.
OVERRIDE_FILES = {
    "frontaliere": ["packages/articles/engine/shared/frontaliere-article-canonical-overrides.json", "engine/shared/frontaliere-article-canonical-overrides.json"],
    "svizzera": ["data/swiss-article-canonical-overrides.json", "content/swiss-article-canonical-overrides.json"],
}


def override_files(spark: SparkSession, root: str, layouts: list[str]) -> DataFrame:
    """(section, ordinal, value): the candidate files of every section, ``ordinal`` being the place of their
    layout in the order in which they're tried. A layout is a path under ``root``; where folders section=... stand in it, each
    is a section, else the section is null. Layouts that aren't there are left out; a probe lists a path alone, files
    are read by the executors."""
    found = None
    for ordinal, layout in enumerate(layouts):
        try:
            files = spark.read.text(f"{root}/{layout}", wholetext=True)
        except AnalysisException:
            continue
        section = F.col("section").cast("string") if "section" in files.columns else F.lit(None).cast("string")
        own = files.select(section.alias("section"), F.lit(ordinal).alias("ordinal"), "value")
        found = own if found is None else found.unionByName(own)
    return spark.createDataFrame([], "section string, ordinal int, value string") if found is None else found


def first_overrides(files: DataFrame) -> DataFrame:
    """(section, slug, winner_url) of each section's first file that parses, whatever it holds; one that
    doesn't is passed over. The verdict comes from the content, all sections in one job."""
    good = files.filter(F.try_parse_json(F.col("value")).isNotNull())
    first = good.groupBy("section").agg(F.min_by("value", "ordinal").alias("value"))
    return overrides(first, "value", "section")


def overrides(text: DataFrame, column: str, *keep: str) -> DataFrame:
    """(slug, winner_url) of the member ``overrides`` of a JSON object; what isn't an URL is left out, and without the
    member there are none."""
    member = F.from_json(column, "overrides map<string,string>")["overrides"]
    return text.select(*keep, F.explode(member).alias("slug", "winner_url")).filter(F.startswith("winner_url", F.lit("http")))


def remapped(path: Column, exact: dict[str, str], prefixes: list[tuple[str, str]]) -> Column:
    """The exact map, then the first prefix that fits, else as it is."""
    out = None
    for a, b in exact.items():
        out = F.when(path == a, b) if out is None else out.when(path == a, b)
    for a, b in prefixes:
        hit, new = F.startswith(path, F.lit(a)), F.concat(F.lit(b), F.substring(path, len(a) + 1, 1 << 20))
        out = F.when(hit, new) if out is None else out.when(hit, new)
    return path if out is None else out.otherwise(path)


def orphan_candidates(queries: DataFrame) -> DataFrame:
    """Valid entries in order of ``ordinal``, one for each headline whatever its case."""
    rows = queries.withColumn("headline", trimmed(F.col("query"))).filter((F.col("headline") != "") & articleable(F.col("headline")))
    number = lambda c: F.coalesce(F.expr(f"try_cast({c} as double)"), F.lit(0.0)).alias(c)
    return keep_first(rows, F.lower("headline"), ["ordinal"]).select("headline", *[number(c) for c in ("imp", "pos", "ctr", "clicks")], F.lit("orphan").alias("source"))


def trend_candidates(trends: DataFrame, proven: DataFrame, anchored) -> DataFrame:
    """Trends (ordinal, keyword, score, geo, seed) as candidates: one for each headline whatever its
    case, the first that no proven query equals and that ``anchored`` (Column to boolean Column) holds
    for, with the compressed score and the raw one (null if it is 0 or no number)."""
    rows = trends.withColumn("headline", trimmed(F.coalesce("keyword", F.lit("")))).filter("headline <> ''").filter(anchored(F.col("headline")))
    known = proven.select(F.lower(trimmed(F.col("query"))).alias("_key")).distinct()
    first = keep_first(rows.withColumn("_key", F.lower("headline")).join(known, "_key", "left_anti"), F.col("_key"), ["ordinal"])
    raw = F.expr("try_cast(score as double)")
    return first.select("headline", F.lit("trends").alias("source"), trend_score(raw).alias("score"), F.when(~F.isnan(raw), F.nullif(raw, F.lit(0.0))).alias("rawScore"), "geo", "seed")


def unproven(candidates: DataFrame, proven: DataFrame, anchor: str) -> DataFrame:
    """Candidates that no proven query equals and that hold a domain anchor."""
    key = F.lower(trimmed(F.col("headline")))
    own = proven.select(F.lower(trimmed(F.col("query"))).alias("_key")).distinct()
    return candidates.withColumn("_key", key).join(own, "_key", "left_anti").filter(F.col("headline").rlike(f"(?iu){anchor}")).drop("_key")


#: JPEG markers that stand alone, without a length: restarts, start and end of image.
_ALONE = frozenset(range(0xD0, 0xDA))
#: JPEG markers from C0 to CF that begin no frame: tables and reserved.
_NO_FRAME = frozenset((0xC4, 0xC8, 0xCC))


def _webp_size(b: bytes) -> tuple[int, int] | None:
    kind, number = b[12:16], lambda at, n: int.from_bytes(b[at : at + n], "little")
    if len(b) < 30:
        return None
    if kind == b"VP8X":
        return number(24, 3) + 1, number(27, 3) + 1
    if kind == b"VP8L":
        return (number(21, 4) & 0x3FFF) + 1, (number(21, 4) >> 14 & 0x3FFF) + 1
    if kind == b"VP8 ":  # the start code of a frame stands within the first bytes of the data
        at = b.find(b"\x9d\x01\x2a", 20, 43)
        return (number(at + 3, 2) & 0x3FFF, number(at + 5, 2) & 0x3FFF) if 0 <= at <= len(b) - 7 else None
    return None


def _jpeg_size(b: bytes) -> tuple[int, int] | None:
    at = b.find(b"\xff", 2)
    while 0 <= at < len(b) - 9:
        marker = b[at + 1]
        if 0xC0 <= marker <= 0xCF and marker not in _NO_FRAME:
            return int.from_bytes(b[at + 7 : at + 9], "big"), int.from_bytes(b[at + 5 : at + 7], "big")
        step = 2 if marker in _ALONE else 2 + int.from_bytes(b[at + 2 : at + 4], "big")
        at = b.find(b"\xff", at + (1 if marker == 0xFF else step))  # a marker may have fill bytes before it
    return None


def size_of_image(b: bytes | None) -> tuple[int | None, int | None]:
    """(width, height) by the header; (None, None) where none is found or a side is 0."""
    b, size = b or b"", None
    if b[:4] == b"RIFF" and b[8:12] == b"WEBP":
        size = _webp_size(b)
    elif b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        size = int.from_bytes(b[16:20], "big"), int.from_bytes(b[20:24], "big")
    elif b[:3] == b"GIF" and len(b) >= 10:
        size = int.from_bytes(b[6:8], "little"), int.from_bytes(b[8:10], "little")
    elif b[:2] == b"\xff\xd8":
        size = _jpeg_size(b)
    elif b[4:8] == b"ftyp" and (box := b.find(b"ispe")) >= 0 and len(b) >= box + 16:
        size = int.from_bytes(b[box + 8 : box + 12], "big"), int.from_bytes(b[box + 12 : box + 16], "big")
    return size if size and min(size) > 0 else (None, None)


@F.pandas_udf(StructType([StructField("width", IntegerType()), StructField("height", IntegerType())]))
def image_size(content: pd.Series) -> pd.DataFrame:
    """from the headers of webp, png, jpeg, gif and avif files; null where none is found."""
    return pd.DataFrame([size_of_image(b) for b in content], columns=["width", "height"]).astype("Int32")


@lru_cache(64)
def _system(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark lists it, and the path in it. The path is taken as it is, not as an URI."""
    scheme, _, rest = path.rpartition(":") if path.startswith("file:") else path.partition("://")
    if path.startswith("file:") or not rest:
        return fs.LocalFileSystem(), "/" + (path.removeprefix("file:")).lstrip("/")
    authority, _, inside = rest.partition("/")
    system, base = _system(f"{scheme}://{authority}/")
    return system, f"{base.rstrip('/')}/{inside}"


def image_sizes(spark: SparkSession, path: str, head: int = 65_536) -> DataFrame:
    """(path, width, height) of the files under ``path``. Tasks list them (see ``listed_files``) and read the first
    ``head`` bytes of each, however long it is. The file system must be one that pyarrow opens: local, HDFS, S3 or GCS.
    A file that is gone by then, or no image, has no size."""
    listed = listed_files(spark, path)
    if listed is None:
        raise ValueError(f"pyarrow doesn't open the file system of {path}")
    listed = listed.repartition(max(1, -(-listed.count() // FILES_A_TASK)), "path")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sizes = []
            for name in f["path"]:
                system, inside = opened(name)
                try:
                    with system.open_input_file(inside) as file:
                        sizes.append(size_of_image(file.read(head)))
                except FileNotFoundError:
                    sizes.append((None, None))
            yield pd.concat([f, pd.DataFrame(sizes, columns=["width", "height"], index=f.index).astype("Int32")], axis=1)

    return listed.mapInPandas(read, "path string, width int, height int")
