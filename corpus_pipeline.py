"""From raw documents to token ids: toxicity, exact dedup, near dedup, benchmark decontamination, byte-level BPE.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last return the rows of ``docs`` they keep,
with all its columns; the last returns one row of token figures per document. ``run`` writes each stage's rows to the
shared folder and reads them back for the next, so a lost executor costs at most the stage at hand.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from relfeat.llm.byte_bpe import encode_and_decode
from relfeat.llm.common import stored, without
from relfeat.llm.decontaminate import decontaminate
from relfeat.llm.exact_dedup import exact_dedup
from relfeat.llm.near_dedup import near_dedup
from relfeat.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a toxicity score of 0.3 or more; the classifier learns from the labels of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without(docs, toxicity(docs, labels, threshold=0.3).where("predicted = 1"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to the case of A-Z, keep the one with the largest id."""
    return without(docs, exact_dedup(docs, keep="largest").where("NOT kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 of five-word shingles, keep the one with the smallest id."""
    return without(docs, near_dedup(docs, words_each=5, similar=(4, 5)).where("NOT kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of whose words one in twenty or more lies in a 13-word passage of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, decontaminate(docs, items).where("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document that is left."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_and_decode(docs, ranks, public_tokenizers.PATTERN, with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

# SQL cannot express the toxicity classifier: the tests compare run() with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
