"""Preparing a corpus: five stages over ``documents``, each reading what the one before wrote.

Quality rules drop documents and failed lines; line dedup drops lines that many documents share;
MinHash near-dedup leaves one document of each group; mixing samples documents so that sources,
languages and topics approach their target weights; BPE encodes what is left and decodes it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsloom.llm.bpe import encode
from obsloom.llm.common import stored
from obsloom.llm.lines import dedup_lines
from obsloom.llm.minhash import near_duplicates
from obsloom.llm.mixing import annotated, mix
from obsloom.llm.quality import quality_rules
from obsloom.llm.queries import vocabulary_path
from obsloom.registered.common import table

#: SQL cannot express near-dedup by signatures or BPE; tests compare the rows with a plain version.
ORACLE_SQL = None


def apart(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and all but the text in a struct, where no operator's own columns replace them."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("__row"), "doc_id", "text", "source", "lang")


def as_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with the text as it is now and its length."""
    now = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return rows.select(*[now.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that failed."""
    return as_documents(quality_rules(apart(docs).select("__row", "text")).where("kept").withColumn("text", F.col("cleaned")), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many of them share."""
    return as_documents(dedup_lines(apart(docs).select("__row", "doc_id", "text")), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all without an id."""
    keep = near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(keep, F.col("doc_id") == F.col("__id"), "left_semi").unionByName(docs.where("doc_id is null"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents at the target weights."""
    return as_documents(mix(annotated(apart(docs))).where("kept"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the text that these decode to."""
    return encode(docs, vocabulary_path(), decoded=True).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("minhash near-dedup", near), ("mixing", mixing), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage makes of ``documents``; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
