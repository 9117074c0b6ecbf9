"""The registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.alignment import align_tokenizers
from lectern.llm.bpe import digests, encode_documents
from lectern.llm.licenses import scan_licenses
from lectern.llm.line_dedup import dedup_lines
from lectern.llm.mixing import mix
from lectern.llm.neighbours import nearest
from lectern.llm.quality import quality_rules
from lectern.llm.repeats import remove_repeats
from lectern.llm.secrets import base_spans, scan_secrets, spans_text
from lectern.llm.simhash import near_duplicates
from lectern.llm.token_files import read_tokens, write_tokens
from lectern.llm.turns import damaged, repair_conversations
from lectern.llm.warc import read_index, write_archive
from lectern.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    read = read_index(spark, path)
    return read.select(F.col("source_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=20, is_query=F.col("vec_id") % 20 == 0)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, tokenizer_path("word_bpe_49k.json"), digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_length=1)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
    return read_tokens(spark, path)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_words_removed", "kept")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans_text(base_spans(F.col("spans"))), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = align_tokenizers(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_warc_archive, op2_learned_partitions, op3_bpe_codec, op4_line_dedup, op5_source_mix, op6_simhash, op7_repeats, op8_token_files, op9_quality_rules, op10_license_scan, op11_secret_scan, op12_turn_repair, op13_token_alignment)}

ORACLE_SQL = {
    "op1_warc_archive": """
with p as (select page_id, encode(coalesce(html, '')) b from pages),
d as (select page_id, octet_length(b) n, sha1(b) h from p),
m as (select h, n, max(page_id) lead from d where n >= 1000 group by h, n)
select d.page_id, cast(d.n as bigint) payload_bytes, d.h payload_digest,
 case when m.lead is null or m.lead = d.page_id then 'response' else 'revisit' end record_type,
 case when m.lead <> d.page_id then m.lead end refers_to
from d left join m on d.h = m.h and d.n = m.n""",
    "op4_line_dedup": r"""
with docs as (select doc_id, row_number() over () rid, coalesce(text, '') t from documents),
lines as (select doc_id, rid, unnest(string_split(t, chr(10))) line, generate_subscripts(string_split(t, chr(10)), 1) pos from docs),
keyed as (select *, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from lines),
often as (select k from keyed where length(k) >= 1 group by k having count(distinct rid) >= 10)
select max(doc_id) doc_id, count(*) n_lines, count(*) filter (often.k is not null) n_dropped,
 sha256(coalesce(string_agg(line, chr(10) order by pos) filter (often.k is null), '')) kept_sha256
from keyed left join often on keyed.k = often.k group by rid""",
}
