"""From raw documents to token ids: quality rules, near-duplicates, secrets, source weights, token ids.

Each stage reads the Parquet table that the one before it wrote.  All but the last return the columns of documents.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing, quality_gbt, secrets, sentencepiece_codec, simhash
from quarry.llm.common import free_name, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_gbt.kept_documents(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=4, most=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to their kind in brackets; n_chars follows the text."""
    spans = free_name(docs, "spans")
    clean = secrets.find_secrets(docs, spans=spans, redact_to="text")
    changed = clean.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars"))
                               .cast(docs.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.sample_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document left (end id last), and the digest of the text that they decode to."""
    import public_tokenizers
    coded = sentencepiece_codec.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "source"])
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_weights),
    ("SentencePiece encoding", token_ids),
]

#: The trees, XXH64 fingerprints and token ids have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; between them, tables in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "pipeline")
    return docs
