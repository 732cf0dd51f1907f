"""The corpus pipeline: documents through five of the operators of aggrex.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aggrex.llm import bpe, decontaminate, pii, simhash, toxicity
from aggrex.llm.common import materialise

TOKENIZER = "word_bpe_49k.json"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model grades 0; learnt from the labelled ones among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.learn(docs, labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every SimHash group."""
    return simhash.keep_one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else clean[c]
                          for c in clean.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe.bpe_encode_decode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_copies),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("bpe", tokens),
]

ORACLE_SQL = None  # the model, edit distances and BPE are beyond SQL; tests compare with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
