"""Registered queries of the operators, over their whole tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsloom.llm import sql
from obsloom.llm.bpe import encode
from obsloom.llm.centroids import cluster, with_inertia
from obsloom.llm.chaining import fuzzy_passages
from obsloom.llm.lines import dedup_lines
from obsloom.llm.minhash import near_duplicates
from obsloom.llm.lm import lm_scores
from obsloom.llm.mining import hard_negatives
from obsloom.llm.mixing import annotated, mix
from obsloom.llm.quality import quality_rules
from obsloom.llm.suffix import repeated_substrings
from obsloom.llm.urls import ALLOW, BLOCK, filter_urls
from obsloom.llm.vectors import near_vectors
from obsloom.llm.warc import archive_pages, page_ids, read_records
from obsloom.registered.common import Registry, table

#: Rules of the URL filter, host with path start.
URL_RULES = ((ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A file of the published vocabularies that are installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def register(registry: Registry) -> None:
    @registry.add("op1_lm_scores")
    def op1(spark, sf_dir):
        return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path("byte_bpe_50k.tiktoken"))

    @registry.add("op5_line_dedup", sql.LINE_DEDUP)
    def op5(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))

    @registry.add("op7_url_filter", sql.url_filter(URL_RULES))
    def op7(spark, sf_dir):
        pages = table(spark, sf_dir, "pages").select("page_id", "url")
        return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))

    @registry.add("op8_mix_sources", sql.MIX)
    def op8(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
        mixed = mix(annotated(docs).drop("text"))
        return mixed.select(
            "doc_id", "topic", "n_tokens", F.round("weight", 5).alias("weight"), F.round("probability", 5).alias("probability"), "kept"
        )

    @registry.add("op2_minhash_dedup")
    def op2(spark, sf_dir):
        return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))

    @registry.add("op3_embedding_dedup")
    def op3(spark, sf_dir):
        return near_vectors(table(spark, sf_dir, "embeddings"))

    @registry.add("op4_bpe")
    def op4(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        ids = F.array_join(F.col("ids").cast("array<string>"), ",")
        return encode(docs, vocabulary_path(), decoded=True).select(
            "doc_id",
            F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(ids, 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256"),
        )

    @registry.add("op6_quality_rules", sql.QUALITY)
    def op6(spark, sf_dir):
        judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
        return judged.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"
        )

    @registry.add("op9_suffix_dedup")
    def op9(spark, sf_dir):
        found = repeated_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
        return found.select(
            "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
        )

    @registry.add("op10_fuzzy_passages")
    def op10(spark, sf_dir):
        found = fuzzy_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
        return found.select("doc_id", "n_words", "n_removed", F.size("spans").cast("long").alias("n_spans"), "spans", "first_docs")

    @registry.add("op11_centroids", sql.centroids())
    def op11(spark, sf_dir):
        return with_inertia(cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))).drop("centroid")

    @registry.add("op12_warc", sql.WARC)
    def op12(spark, sf_dir):
        index, folder = archive_pages(table(spark, sf_dir, "pages"))
        found = page_ids(read_records(index, folder, payloads=False))
        return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

    @registry.add("op13_hard_negatives", sql.HARD_NEGATIVES)
    def op13(spark, sf_dir):
        vectors = table(spark, sf_dir, "embeddings")
        label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)
