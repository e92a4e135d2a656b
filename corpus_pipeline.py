"""Training-text pipeline: good documents, one of each group, without test passages and personal data, as tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.bpe import run_encode
from ledgerlane.llm.decontaminate import run_decontaminate
from ledgerlane.llm.near_dup import run_near_duplicates, text_sha256
from ledgerlane.llm.pii import run_redact
from ledgerlane.llm.quality import run_keep_good
from ledgerlane.llm.storage import cut, discard

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant accepts.

    Null and empty texts are judged by statistics of zeros; repeated rows stay or go together.
    """
    return run_keep_good(docs, _table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates (five words, 0.8), and once only.

    Rows of one id and different texts go or stay each by its own text; null and blank texts are like no
    other and stay, once per id.
    """
    others = run_near_duplicates(docs, digests=True).where("not kept").select("doc_id", "text_sha256").distinct()
    same = (docs["doc_id"] == others["doc_id"]) & (text_sha256(docs["text"]) == others["text_sha256"])
    return docs.join(others, same, "left_anti").dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of benchmark items; all rows stay, null texts as they are."""
    return run_decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with markers for personal data; all rows stay, null texts as they are."""
    return run_redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and what these decode to, as a digest; null texts have no ids."""
    encoded = run_encode(docs, public_tokenizers.path(VOCABULARY), decoded=True)
    return encoded.withColumn("decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256)).drop("decoded")


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one),
    ("benchmark decontamination", cut_benchmark),
    ("PII", redact),
    ("BPE encoding and decoding", encode),
]

#: SQL can't express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again."""
    docs, written = _table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        discard(*written)
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
