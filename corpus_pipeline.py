"""From raw documents to packed training sequences: language, lines, near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import decontaminated
from tidemark.llm.language import UNKNOWN, identified, train
from tidemark.llm.line_dedup import without_shared_lines
from tidemark.llm.near_dedup import first_of_each
from tidemark.llm.packing import pack
from tidemark.session import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters; `lang` becomes the predicted language, however mixed or short the text.

    Rejected are texts without a letter (`und`). Where no row has a language, none can be learned and all rows stay as they are.
    """
    docs = docs.select(*COLUMNS)
    weights, languages = train(docs)
    if not languages:
        return docs
    return identified(docs, weights, languages).where(F.col("lang_pred") != UNKNOWN).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a larger doc_id keeps; what has no word left goes, as others hold all of it."""
    rows = without_shared_lines(docs.select(*COLUMNS)).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return first_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 4096."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language and tokens cannot be asked in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as Parquet and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
