"""The queries of the operators over the given tables, with production parameters.

Where SQL can express a result exactly, ``ORACLES`` has DuckDB SQL for it; the others (trained models, tokenizers, seeded draws, sums of
floating-point numbers) are held against brute force in tests/llm."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codestrata.llm import check_sql
from codestrata.llm.common import Scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op3_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm import token_ids

    folder = Scratch(spark, "token-ids").path
    token_ids.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, end_id=1)
    return token_ids.digest(spark, folder)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.decontamination import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.relative_lz import without_repeats

    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.suffix_levels import without_shared

    return without_shared(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.mixing import Mix

    return Mix(table(spark, sf_dir, "documents")).counted()


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.jaccard_join import linked

    return linked(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm import token_counts

    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.link_graph import judged

    return judged(table(spark, sf_dir, "pages"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codestrata.llm.merkle import audit

    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return audit(table(spark, sf_dir, "documents"), changed, n_chars=F.col("n_chars") + 1)


ORACLES |= {
    "op4_decontamination": check_sql.DECONTAMINATION, "op5_substring_dedup": check_sql.SUBSTRING_DEDUP, "op6_suffix_array_dedup": check_sql.SUFFIX_DEDUP,
    "op8_jaccard_join": check_sql.JACCARD_JOIN, "op11_url_filters": check_sql.url_filters(), "op12_collocations": check_sql.COLLOCATIONS,
    "op13_merkle_manifest": check_sql.merkle_manifest(),
}
