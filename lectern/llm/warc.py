"""A content-addressed WARC archive.

Three tables in a shared folder: ``index`` (a row for each record: ids, digest, length),
``headers`` (the exact header bytes of each record and the digest that its payload has) and
``payloads`` (each distinct payload once, under its SHA-256). A record is its header, its HTTP
header and, unless it is a revisit, its payload; ``read_records`` joins them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import new_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def urn(h: Column) -> Column:
    """A record id made from a hash of the record, so that a rerun writes the same archive."""
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12)), F.lit(">"))


def one_line(c: Column) -> Column:
    """A header value must not hold line ends."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]", "%0A")


def write_archive(pages: DataFrame, path: str | None = None, min_revisit: int = 1000, date: str = "2024-01-01T00:00:00Z", id: str = "page_id", url: str = "url", payload: str = "html") -> str:
    """Writes a record for each row and returns the folder.

    Of rows whose payloads of at least ``min_revisit`` bytes are equal, that with the largest id is
    the response, the others are revisits of it; of several with that id, one. Null ids are below
    all others, null payloads are empty, null URLs are empty. Extra columns are left out, whatever
    their names. Payloads count as equal if SHA-256, SHA-1 and length are. Equal rows are numbered, so each is
    a record of its own, and the archive doesn't depend on how the rows were partitioned. An empty table
    gives an empty archive.

    The payloads are exchanged once, one a digest and map task; all else moves digests and ids.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    body = F.encode(F.coalesce(F.col(f"`{payload}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload"))
    digests = (F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
    same = rows.select("id", "url", *digests).groupBy("id", "url", "sha256", "sha1", "n_bytes").count()
    each = same.select("id", "url", "sha256", "sha1", "n_bytes", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    record = F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in ("id", "url", "sha256", "copy")]))
    each.select(record.alias("record"), "id", "url", "sha256", "sha1", "n_bytes").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    rows.select(*digests, "payload").groupBy("sha256", "sha1", "n_bytes").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")

    lead = index.filter(F.col("n_bytes") >= min_revisit).groupBy("sha256").agg(F.max(F.struct("id", "record", "url")).alias("lead"))
    lead.write.parquet(f"{path}/leads")  # apart, so that Spark can split the join of a payload that very many records share
    lead = spark.read.schema(lead.schema).parquet(f"{path}/leads")
    both = index.join(lead, "sha256", "left")
    revisit = F.col("lead").isNotNull() & (F.col("lead.record") != F.col("record"))
    rid, lead_rid = urn(F.col("record")), urn(F.col("lead.record"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(CRLF * 2))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", rid),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", one_line(F.col("url"))),
        field("X-Source-ID", F.coalesce(F.col("id").cast("string"), F.lit(""))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit(PROFILE)), field("WARC-Refers-To", lead_rid), field("WARC-Refers-To-Target-URI", one_line(F.col("lead.url"))), field("X-Refers-To-Source-ID", F.coalesce(F.col("lead.id").cast("string"), F.lit(""))))).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", length.cast("string")),
        F.lit(CRLF),
    )
    both.select("record", "sha256", F.encode(header, "UTF-8").alias("header"), F.encode(http, "UTF-8").alias("http_header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    return path


def base32(hex40: Column) -> Column:
    """The base-32 form of a SHA-1: 160 bits are 32 letters of 5 bits, taken from blocks of 5 hex digits."""
    letters = []
    for block in range(8):
        n = F.conv(F.substring(hex40, block * 5 + 1, 5), 16, 10).cast("long")
        letters += [F.substring(F.lit(_BASE32), (F.shiftright(n, s).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def header_field(name: str) -> Column:
    return F.nullif(F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; one that doesn't have the digest it is stored under is an error."""
    stored = spark.read.parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload is damaged: "), F.col("sha256"))).cast("binary")
    return stored.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(wrong))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, warc): each record's exact bytes, header and block joined by digest. The payloads are
    verified, and an empty archive gives no rows."""
    heads = spark.read.parquet(f"{path}/headers")
    revisit = F.contains(F.decode("header", "UTF-8"), F.lit(f"{CRLF}WARC-Type: revisit{CRLF}"))
    with_body = heads.filter(~revisit).join(payloads(spark, path).select("sha256", "payload"), "sha256")
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    return with_body.select("record", F.concat("header", "http_header", "payload", end).alias("warc")).unionByName(heads.filter(revisit).select("record", F.concat("header", "http_header", end).alias("warc")))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """What the archive says of each record: source_id (null for a null id), record_type, refers_to (source
    id), and the length and SHA-1 of its full payload as worked out from the stored bytes. A payload
    without the digest that the record's header states is an error. An empty archive gives no rows."""
    heads = spark.read.parquet(f"{path}/headers").select(
        "record", "sha256", header_field("X-Source-ID").alias("source_id"), header_field("WARC-Type").alias("record_type"), header_field("X-Refers-To-Source-ID").alias("refers_to"),
        header_field("WARC-Payload-Digest").alias("stated"),
    )
    sha1 = F.sha1("payload")
    bodies = payloads(spark, path).select("sha256", F.octet_length("payload").cast("long").alias("payload_bytes"), sha1.alias("payload_digest"), F.concat(F.lit("sha1:"), base32(sha1)).alias("found"))
    wrong = F.raise_error(F.concat(F.lit("a record states another digest than its payload has: "), F.col("record"))).cast("string")
    joined = heads.join(bodies, "sha256")
    return joined.select("record", "source_id", "record_type", "refers_to", "payload_bytes", F.when(F.col("stated") == F.col("found"), F.col("payload_digest")).otherwise(wrong).alias("payload_digest"), "stated")
