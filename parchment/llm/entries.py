"""Queries of this subpackage, by name, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.llm import collocations, decontaminate, embedding_dedup, hamerly, language_id, media, minhash, packing, pii, secrets, suffix_dedup, toxicity, warc
from parchment.llm.common import crc_mod, table
from parchment.llm.corpus_sql import clusters_sql, collocations_sql, grouped_sql
from parchment.llm.span_sql import PII, SECRETS
from parchment.llm.spans import digest


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(True))
    profiles = language_id.learn_profiles(docs.where(~held))
    return language_id.identify(docs.select("doc_id", held.alias("held_out"), "text"), profiles).drop("text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(True))
    model = toxicity.train_joined(docs, labels.where(~held))
    scored = toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def vocabulary() -> tuple[str, str]:
    """Paths of the public vocabulary: for the tokenizers library, and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), *vocabulary())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _counted(found: DataFrame, spans: str, base: tuple[str, ...], *more: Column) -> DataFrame:
    """The digest columns of the span operators, and more."""
    of = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    strong = F.filter(spans, lambda s: s["kind"].isin(*base))
    return found.select("doc_id", *(of(k).alias(f"n_{k}") for k in base), F.sha2(digest(strong), 256).alias("base_sha256"), digest(F.col(spans)).alias("spans"), *more)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _counted(secrets.with_spans(docs, out="found").drop("text"), "found", secrets.BASE_KINDS, F.size(F.filter("found", lambda s: s["linked"])).cast("long").alias("n_linked"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _counted(pii.with_spans(docs, out="found").drop("text"), "found", pii.BASE_KINDS, F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamerly.clusters(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.grouped(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_minhash": op4_minhash,
    "op5_media_columns": op5_media_columns,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_secret_scan": op9_secret_scan,
    "op10_pii": op10_pii,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_collocations": op12_collocations,
    "op13_embedding_dedup": op13_embedding_dedup,
}

_HEX = "'0x' || substr(d, {0}, 5)"
#: Base32 of a SHA-1: eight times five hexadecimal digits make four characters.
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((({_HEX.format(5 * i + 1)})::bigint >> {s}) & 31) + 1)::bigint, 1)" for i in range(8) for s in (15, 10, 5, 0))

ORACLE: dict[str, str] = {
    # islands of repeated windows are the removed runs; what is kept is joined as hexadecimal text
    "op6_suffix_dedup": """
with d as (select doc_id, encode(coalesce(text, '')) t, hex(encode(coalesce(text, ''))) h from documents),
w as (select doc_id, unnest(range(0, greatest(octet_length(t) - 99, 0))) s, t from d),
q as (select doc_id, s, md5_number(cast(t[s + 1:s + 100] as blob)) m from w),
r as (select doc_id, s, row_number() over (partition by m order by doc_id, s) n from q),
g as (select doc_id, s, coalesce(s > lag(s) over (partition by doc_id order by s) + 100, true) fresh from r where n > 1),
i as (select doc_id, s, sum(fresh::int) over (partition by doc_id order by s) k from g),
x as (select doc_id, k, min(s) a, max(s) + 100 b from i group by all),
y as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) before, k = max(k) over (partition by doc_id) last from x),
z as (select y.doc_id, sum(b - a) removed, count(*) spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || case when last then substr(h, 2 * b + 1) else '' end, '' order by a) kept from y join d using (doc_id) group by all)
select doc_id, (length(h) // 2)::bigint n_bytes, coalesce(removed, 0)::bigint n_removed, coalesce(spans, 0)::bigint n_spans, sha256(unhex(case when z.doc_id is null then h else kept end)) kept_sha256 from d left join z using (doc_id)""",
    "op8_warc": f"""
with p as (select page_id, coalesce(html, '') h from pages),
q as (select page_id, strlen(h)::bigint payload_bytes, sha1(h) d from p),
r as (select *, max(page_id) over (partition by d, payload_bytes) last_id from q)
select page_id, payload_bytes, {_BASE32} payload_digest,
       case when last_id is not null and page_id is distinct from last_id then 'revisit' else 'response' end record_type,
       case when last_id is not null and page_id is distinct from last_id then last_id end refers_to
from r""",
    "op9_secret_scan": SECRETS,
    "op10_pii": PII,
    "op11_centroid_clustering": clusters_sql(),
    "op12_collocations": collocations_sql(),
    "op13_embedding_dedup": grouped_sql(),
}
