"""The registered queries of the operators; importing this module registers them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.llm import bottom_k, dictionary_warc, hilbert_shards, hyperminhash, language_id, latent_decontamination, maxent_lm, mixing, partenum, source_audit, suffix_dedup, surrogates, token_alignment
from gaugework.llm.frames import id_crc, table
from gaugework.llm.registry import query
from gaugework.llm.sql import ARCHIVES_SQL, AUDIT_SQL, curve_sql, jaccard_join_sql, mixing_sql, near_duplicates_sql


@query("op1_hilbert_shards", curve_sql())
def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shard(table(spark, sf_dir, "documents"))


@query("op2_bottom_k")
def op2_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bottom_k.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", bottom_k.text_of("sketch").alias("fingerprint"), bottom_k.text_of("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.labelled(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    held = (id_crc("doc_id") % 4 == 2).alias("held_out")
    return found.select("doc_id", held, F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"))


@query("op5_latent_decontamination")
def op5_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_dictionary_warc", ARCHIVES_SQL)
def op6_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dictionary_warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_hyperminhash", near_duplicates_sql())
def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op8_surrogates")
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("entities").cast("long").alias("n_entities"), "entities", "text")


@query("op9_maxent_lm")
def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.scored(table(spark, sf_dir, "documents"))


@query("op10_mixing", mixing_sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_partenum_join", jaccard_join_sql(size=3, percent=90))
def op11_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.joined(table(spark, sf_dir, "documents"), size=3, percent=90)


# Where the public vocabulary files lie on the machine that plans the job; tasks get their content.
VOCABULARIES = "/opt/tokenizers"


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str, vocabularies: str = VOCABULARIES) -> DataFrame:
    a, b = (Path(vocabularies, name).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align(table(spark, sf_dir, "documents"), a, b)


@query("op13_source_audit", AUDIT_SQL)
def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))
