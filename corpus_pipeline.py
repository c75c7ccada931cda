"""The corpus pipeline: five stages over whole documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weekpanel.llm import bpe, decontam, quality, secrets, simhash
from weekpanel.llm.common import table
from weekpanel.session import scratch_path

#: SQL can express neither the classifier nor the network; tests compare the stages with brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts (score of at least 0.3). It learns from the labelled documents
    of the stage's input.

    Null and empty texts get the score of the labels' share. Repeated rows are judged each, other columns stay as they
    are whatever their names, an empty table stays empty.
    """
    return quality.accept(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id.

    Null, empty and wordless texts are one group. Rows of one id and text are one document, null ids too; of different
    texts under one id each belongs to its own group. Other columns stay, an empty table stays empty.
    """
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window.

    Null and empty texts stay. Repeated rows are judged each, other columns stay as they are, an empty table stays empty.
    """
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced by a mark, and n_chars follows the text.

    Null texts stay null, with a null n_chars. Repeated rows and other columns stay, an empty table stays empty.
    """
    redacted = secrets.redact(docs)
    return redacted.selectExpr(*[f"bigint(length(text)) as {c}" if c == "n_chars" else f"`{c}`" for c in docs.columns])


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding gives its text back.

    Null and empty texts have no ids. Repeated rows stay; only the columns named here are returned; an empty table gives
    no rows.
    """
    encoded = bpe.encode(docs)
    exact = "decoded = coalesce(text, '') as round_trip"
    return encoded.selectExpr("doc_id", "lang", "source", "ids", "n_tokens", "sha2(decoded, 256) as text_sha256", exact)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What each stage keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
