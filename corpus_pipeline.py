"""A corpus from raw documents to stored token ids, in five stages.

Every stage gets what its predecessor kept, written as Parquet; all but the last return the columns of ``documents``, whatever
further ones there are and whatever their names.  Null and empty texts pass the first three stages; the mix takes only documents
with words.  Null ids stay, repeated rows go in the second stage, an empty table stays empty through all of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codestrata.llm import decontamination, jaccard_join, token_ids, toxicity
from codestrata.llm.common import Scratch, free_name, text_key
from codestrata.llm.mixing import Mix


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words the severity model does not reject; it is trained on labelled rows among them."""
    return toxicity.without_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id; rows that repeat id and text stay once."""
    own, key = free_name("__id", docs), free_name("__key", docs)
    found = jaccard_join.groups(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(own)).distinct()
    stay = docs.join(found, F.col("doc_id").eqNullSafe(F.col(own)), "left_semi").withColumn(key, text_key())
    return stay.dropDuplicates(["doc_id", key]).drop(key)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: each document as often as it is taken, dealt to shards and shuffled in them."""
    mix = Mix(docs)
    return mix.dealt(mix.rows()).drop(mix.shard, mix.position)


def stored(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in the binary format; one row a document, read back from the files."""
    folder = Scratch(spark, "corpus").path
    token_ids.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"), folder, end_id=1)
    return token_ids.digest(spark, folder)


STAGES = [
    ("toxicity", without_toxic),
    ("jaccard join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token ids", stored),
]

#: Trained models, components and seeded draws are not SQL; tests/llm/test_learned_mixed_near.py runs stage by stage, and each
#: operator is held against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
