"""The registered queries of this subpackage, ``opN_<name>``, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (aligntokens, decontaminate, divergence, knnjoin, langid, licenses, linededup, lmscore, neardup, packing, pii,
               tokencount, warc)
from .shared import new_path

#: A public piece vocabulary; any model file of that library will do.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

#: The other tokenizer of op13.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"

#: Payloads above this are segmented in the archives of op1.
SEGMENT_BYTES = 64 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path, "page_id", "url", F.col("html").cast("binary"), chunk_bytes=SEGMENT_BYTES, revisit_bytes=0)
    out = warc.records(warc.read_chunks(spark, path, chunk_bytes=SEGMENT_BYTES))
    return out.select(warc.urn_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      warc.urn_id(F.col("refers_to")).alias("refers_to"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.sanitise(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind_no"] == pii.KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", *(count(k) for k in ("email", "ip", "card", "phone")),
                      F.sha2(pii.digest_text(F.col("base")), 256).alias("base_sha256"), pii.digest_text(F.col("all_spans")).alias("spans"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(table(spark, sf_dir, "documents"), langid.training_split(F.col("doc_id"), 7, 2))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=10, min_docs=2)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knnjoin.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.training_split(F.col("doc_id"), 3, 1)
    model = langid.train(docs.where(~held_out))
    out = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    initial, continuation = tokencount.sentencepiece_vocabulary(vocabulary)
    out = tokencount.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), initial, continuation)
    return out.select("doc_id", "n_words", "n_tokens", "n_unknown")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents"))
    starts = F.flatten(F.transform("base", lambda x: x["places"]))
    return out.select("doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
                      F.array_max(starts).cast("long").alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


def op13_token_alignment(spark: SparkSession, sf_dir: str, byte_bpe: str = BYTE_BPE, piece_bpe: str = VOCABULARY) -> DataFrame:
    out = aligntokens.align(table(spark, sf_dir, "documents"), byte_bpe, piece_bpe)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_warc, op2_pii, op3_lm_scores, op4_line_dedup, op5_token_counts, op6_near_dedup, op7_exact_topk, op8_best_fit_packing,
                                op9_language_id, op10_decontamination, op11_license_scan, op12_source_divergence, op13_token_alignment)}
