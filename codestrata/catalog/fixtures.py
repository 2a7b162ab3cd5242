"""Repository tables derived from the given ``documents`` and ``events`` tables.

Every document is a file of repository ``org/<source>``; every event is a commit.  All
expressions are per row (no windows, no row numbers), and the SQL texts below are valid in Spark and
DuckDB, so the check SQL uses the same tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codestrata.functions.text import git_blob_sha
from codestrata.operators.skew import join_hot
from codestrata.session import configure

AS_OF_30 = "2024-02-10T00:00:00+00:00"  # the 30-day cutoff falls inside the data
AS_OF_90 = "2024-04-10T00:00:00+00:00"  # the 90-day cutoff falls inside the data

ID = "CAST(doc_id AS STRING)"
#: position inside a repository when sources alternate over 20 values
K = "CAST(floor(doc_id / 20) AS BIGINT)"
PACKAGE = "'pkg' || CAST(40 + doc_id % 20 AS STRING)"
HUB = "'web_' || CAST(60 + doc_id % 20 AS STRING)"

REPO_ID = "'org/' || source"

KIND = f"CAST({K} % 20 + 1 AS INT)"
#: what stands before and after the id in a path, by kind of file 0..19
BEFORE = (
    "docs_,meta_,pkg,web_,svc_,node_modules/x/mod_,PKG/tests/test_,docs/mod_,rs/mod_,rb/mod_,"
    "java/Mod,cmd/mod_,lib/mod_,PKG/mod_,src/core/mod_,lib/deep/er/mod_,lib/mod_,PKG/mod_,PKG/mod_,mod_"
)
AFTER = (
    "/README.md,/MANIFEST,/__init__.py,/index.js,/main.py,.js,.py,.md,.rs,.rb,"
    ".java,.go,.js,.py,.ts,.JSX,.js,.py,.py,SUFFIX"
)
PATH = f"""replace(split_part('{BEFORE}', ',', {KIND}), 'PKG', {PACKAGE}) || {ID} ||
  replace(replace(split_part('{AFTER}', ',', {KIND}),
    'MANIFEST', CASE WHEN lang = 'en' THEN 'package.json' ELSE 'pyproject.toml' END),
    'SUFFIX', CASE WHEN lang = 'en' THEN '.c' ELSE '' END)"""

NL = " || chr(10) || "

#: first lines of a file: headers or imports, by kind of file
PREAMBLE = f"""
CASE
  WHEN {K} % 20 = 0 THEN '# ' || source{NL}'## ' || lang || ' Installation'{NL}
    '### deep'{NL}'##   Usage  '{NL}'#' || chr(10) || chr(10) || 'API docs' || chr(10)
  WHEN {K} % 20 IN (3, 5, 12, 14, 15, 16) THEN
    'import {{ x }} from ''express'';'{NL}
    'import a from ''./mod_' || CAST(doc_id - 400 AS STRING) || ''';'{NL}
    'import w from ''../' || {HUB} || '/index'';'{NL}
    'const b = require(''../../../' || {HUB} || ''');'{NL}
    'const r = require(''/' || {HUB} || '/index.js'');'{NL}
    'const c = require(''express'');'{NL}
    'import(''./dyn+' || lang || ''');' || chr(10)
  WHEN {K} % 20 IN (2, 4, 6, 13, 17, 18) THEN
    'import os'{NL}
    'import ' || {PACKAGE} || '.mod_' || CAST(doc_id - 400 AS STRING){NL}
    'from ' || {PACKAGE} || '.mod_' || CAST(doc_id - 80 AS STRING) || ' import run'{NL}
    'from .helper import h'{NL}'from os.path import join'{NL}
    'import ' || {PACKAGE} || '.mod_' || CAST(doc_id - 400 AS STRING) || chr(10)
  WHEN {K} % 20 = 8 THEN 'use std::io;'{NL}'use crate::a::b;'{NL}'pub mod m' || {ID} || ';' || chr(10)
  WHEN {K} % 20 = 9 THEN
    'require ''json'''{NL}'require_relative ''./mod_' || {ID} || '.rb'''{NL}
    'require_relative ''../' || {HUB} || '/index''' || chr(10)
  WHEN {K} % 20 = 10 THEN 'import java.util.List;'{NL}'import static java.lang.Math.*;' || chr(10)
  WHEN {K} % 20 = 11 THEN
    'import "strings"'{NL}'import ('{NL}' "fmt"'{NL}' "os"'{NL}' "strings"'{NL}')' || chr(10)
  ELSE ''
END"""

#: some files are empty, tiny or (null) unreadable
CONTENT = f"""
CASE WHEN doc_id % 53 = 7 THEN ''
     WHEN doc_id % 59 = 11 THEN 'import os'
     WHEN doc_id % 61 = 13 THEN CAST(NULL AS STRING)
     ELSE {PREAMBLE} || text END"""

SIZE = "CAST(n_chars * CASE WHEN doc_id % 25 = 0 THEN 50 ELSE 1 END AS BIGINT)"
TREE_SHA = f"sha1('blob:' || {ID})"
HEAD_SHA = f"sha1('head:' || {REPO_ID})"

#: one file gets all events of one type, the others share the rest; some get none
EVENT_DOC = "CASE WHEN event_type = 'error' THEN 80 ELSE (event_id - event_id % 10 + user_id % 7) % n END"
AUTHOR = "'user' || CAST(user_id % 7 AS STRING)"
MESSAGE = "event_type || ' ' || props"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _key() -> list[Column]:
    return [F.expr(REPO_ID).alias("repo_id"), F.expr(HEAD_SHA).alias("commit_sha")]


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One head per repository."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(*_key(), F.lit("main").alias("branch")).distinct()


def tree(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Tree entries; the text column is not read."""
    return table(spark, sf_dir, "documents").select(
        *_key(),
        F.expr(PATH).alias("path"),
        F.expr(TREE_SHA).alias("sha"),
        F.expr(SIZE).alias("size"),
        *extra,
    )


def contents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """File contents, null and without an id where unreadable."""
    rows = table(spark, sf_dir, "documents").select(
        *_key(), F.expr(PATH).alias("path"), F.expr(CONTENT).alias("content"), *extra
    )
    return rows.withColumn("blob_sha", F.coalesce(git_blob_sha(F.col("content")), F.lit("")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the document each one touches; the number of documents is a scalar subquery."""
    n = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = table(spark, sf_dir, "events").withColumn("n", n)
    return rows.withColumn("doc_id", F.expr(EVENT_DOC)).drop("n")


def commits(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One commit per event, for the file of its document; one file holds a fifth of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    joined = join_hot(events(spark, sf_dir), docs, ["doc_id"], "inner")
    moment = F.col("ts").cast("timestamp")
    return joined.select(
        *_key(),
        F.expr(PATH).alias("path"),
        F.col("event_id").cast("string").alias("sha"),
        F.expr(AUTHOR).alias("author_name"),
        F.expr(MESSAGE).alias("message"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp_raw"),
        moment.alias("committed_at"),
        (-F.unix_micros(moment)).alias("ordinal"),
        *extra,
    )
