"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, personal data, SentencePiece coding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, minhash, pii, quality_rules, sp_codec
from tidemark.llm.common import read, stage, text_batches
from tidemark.llm.queries import PIECE_MODEL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep. Null and empty texts go; rows that repeat are judged each; a null id, language or source is a value of its own; further columns stay, whatever their names."""
    text_batches(spark)
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the least id. Texts without words and rows without an id stay; all rows of a dropped id go; further columns stay."""
    text_batches(spark)
    return minhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item. Null and empty texts leak nothing, rows without an id stay, all rows of an id that leaks go; an empty benchmark drops nothing; further columns stay."""
    text_batches(spark)
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the new text. Every row stays, null texts stay null (and n_chars with them); further columns stay."""
    text_batches(spark)
    return pii.redact_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, with piece ids; text is decoded from them. Every row stays, null texts come back empty; columns named n_pieces, round_trip or ids give way."""
    text_batches(spark)
    codec = sp_codec.Codec(sp_codec.load_pieces(PIECE_MODEL))
    coded = sp_codec.encode_documents(docs, codec, with_text=True)
    own = [c for c in docs.columns if c not in ("n_pieces", "round_trip", "ids", "ids_hash", "decoded")]
    return coded.withColumnRenamed("decoded", "text").select(*own, "n_pieces", "round_trip", "ids")


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("SentencePiece", encoding),
]

#: SQL can express neither the sampled classes nor the pieces; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each writes its rows and the next reads them."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
