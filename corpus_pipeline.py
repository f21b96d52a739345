"""From raw documents to encoded training text, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet to the shared folder and reads again as the next
stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.llm import byte_bpe, hash_index, odd_sketch, source_mix, subword_quality
from tiersmith.session import stage

#: Documents less likely to be good than this go.
QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learned from ``labels`` of the given tables."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = subword_quality.learn(docs, labels.where(~subword_quality.held_out()))
    # Under numbers, so none of the names can clash with the score's; the text travels once.
    numbers = {name: "text" if name == "text" else f"column_{i}" for i, name in enumerate(docs.columns)}
    rows = docs.select(*[docs[name].alias(number) for name, number in numbers.items()])
    scored = subword_quality.score_documents(rows, model, QUALITY, keep=tuple(numbers.values()))
    return scored.where("predicted = 1").select(*[F.col(number).alias(name) for name, number in numbers.items()])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return hash_index.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five-word shingles and 80 % of the union."""
    return odd_sketch.without_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return source_mix.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to."""
    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "source"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mix", mixed),
    ("byte-level BPE", encoded),
]

#: Learned embeddings and merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; the last one's result, read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
