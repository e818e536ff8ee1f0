"""A cleaning pipeline for ``documents``: resample by quality, drop near copies and benchmark
passages, mask secrets, encode to pieces.

Every stage takes what its predecessor kept and its decisions take effect; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import contamination, near_copies, pieces, quality, secret_scan
from orderlens.llm.common import table
from orderlens.llm.queries import PIECE_MODEL
from orderlens.session import keep

ORACLE_SQL = None  # resampling noise, randomness tests and piece models are not SQL


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance; the rest goes."""
    kept = quality.resample(docs, table(spark, sf_dir, "labels"), columns=docs.columns)
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return near_copies.drop_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` counted anew."""
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids, n_replaced, round_trip) of every document."""
    return pieces.encode(docs, PIECE_MODEL)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding and decoding", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
