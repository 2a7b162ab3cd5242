"""Landed responses, listings and logs -> the tables of :mod:`codestrata.schemas`.

Each source has a ``read_*`` function over files and a ``parse_*`` transform over the landed
rows, so rows that arrive in another table can be parsed as well.  Nothing landed fails the
job: undecodable content is an empty text, and a broken JSON line is found in
:func:`unreadable_lines`."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codestrata import schemas as S
from codestrata.functions.text import git_blob_sha, strip
from codestrata.functions.times import parse_commit_time

#: column that takes a landed line that is no JSON of the expected shape
CORRUPT = "_corrupt_line"
#: commits of one page of a landed commit response; orders pages before positions
PAGE_STRIDE = 1_000_000
#: what ends a line of a landed log: all that the Unicode line rules name
LINE_ENDS = r"\r\n|[\n-\r\x1c-\x1e\x85\u2028\u2029]"


def _json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON lines of a known shape; see :func:`unreadable_lines` for the others."""
    return _json_lines(spark, path, schema).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines :func:`read_json_lines` leaves out, with their file."""
    lines = _json_lines(spark, path, schema).where(F.col(CORRUPT).isNotNull())
    return lines.select("repo_id", F.input_file_name().alias("file"), F.col(CORRUPT).alias("line"))


# tree ---------------------------------------------------------------------------------------


def read_tree_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_tree_json(read_json_lines(spark, path, S.TREE_RESPONSE))


def parse_tree_json(responses: DataFrame) -> DataFrame:
    """Blobs only; a missing size counts as 0.  ``truncated`` marks incomplete listings."""
    items = responses.select(
        "repo_id",
        "commit_sha",
        F.coalesce("truncated", F.lit(False)).alias("truncated"),
        F.explode("tree").alias("e"),
    )
    return items.where(F.col("e.type") == "blob").select(
        "repo_id",
        "commit_sha",
        F.col("e.path").alias("path"),
        F.col("e.sha").alias("sha"),
        F.coalesce("e.size", F.lit(0)).cast("bigint").alias("size"),
        "truncated",
    )


def truncated_trees(responses: DataFrame) -> DataFrame:
    """Snapshots whose listing was cut by the server."""
    text = F.concat(F.lit("tree response truncated for "), F.col("repo_id"))
    return responses.where(F.col("truncated")).select("repo_id", "commit_sha", text.alias("warning"))


def read_tree_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing texts under ``repo_id=.../commit_sha=...`` folders, one entry per line."""
    return parse_tree_listing(spark.read.text(path))


def parse_tree_listing(lines: DataFrame) -> DataFrame:
    """``<mode> <type> <sha> <size>TAB<path>`` in ``value``."""
    halves = F.split("value", "\t", 2)
    meta = F.split(strip(F.get(halves, 0)), r"\s+")
    return (
        lines.select("repo_id", "commit_sha", halves.alias("h"), meta.alias("m"))
        .where((F.size("h") == 2) & (F.size("m") >= 4) & (F.get("m", 1) == "blob"))
        .select(
            "repo_id",
            "commit_sha",
            strip(F.get("h", 1)).alias("path"),
            F.get("m", 2).alias("sha"),
            F.coalesce(F.get("m", 3).try_cast("bigint"), F.lit(0)).cast("bigint").alias("size"),
        )
    )


# contents -----------------------------------------------------------------------------------


def _utf8_or_empty(data: Column) -> Column:
    """Text of strict UTF-8 bytes, else empty.  The check takes the bytes as a string."""
    return F.coalesce(F.try_validate_utf8(data.cast("string")), F.lit(""))


def read_content_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_content_json(read_json_lines(spark, path, S.CONTENT_RESPONSE))


def parse_content_json(responses: DataFrame) -> DataFrame:
    """Base64 with line feeds -> text.  Undecodable content is empty, its id stays."""
    data = F.try_to_binary(F.replace("content", F.lit("\n"), F.lit("")), F.lit("base64"))
    return responses.select(
        *S.FILE, _utf8_or_empty(data).alias("content"), F.coalesce("sha", F.lit("")).alias("blob_sha")
    )


def read_snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """Checked-out files under ``repo_id=.../commit_sha=.../<path>``, read as bytes.  Spark's file
    scan passes over files of no bytes; a file without a content row has an empty text and the tree's
    id, which is what an empty file has anyway."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    # folder values are URL-encoded in file names ("org%2Frepo")
    part = lambda name: F.url_decode(F.regexp_extract("path", f"/{name}=([^/]*)/", 1))
    return parse_snapshot_files(
        files.select(
            part("repo_id").alias("repo_id"),
            part("commit_sha").alias("commit_sha"),
            F.regexp_extract("path", r"(?s)/commit_sha=[^/]*/(.*)\z", 1).alias("path"),
            F.col("content").alias("data"),
        )
    )


def parse_snapshot_files(files: DataFrame) -> DataFrame:
    """Bytes -> text with universal line ends.  Bytes that are no UTF-8 give an empty text and no
    id; the id is that of the bytes as stored."""
    valid = F.try_validate_utf8(F.col("data").cast("string"))
    text = F.regexp_replace(valid, "\r\n?", "\n")
    return files.select(
        *S.FILE,
        F.coalesce(text, F.lit("")).alias("content"),
        F.when(valid.isNull(), F.lit("")).otherwise(git_blob_sha(F.col("data"))).alias("blob_sha"),
    )


# commits ------------------------------------------------------------------------------------


def read_commit_pages(spark: SparkSession, path: str) -> DataFrame:
    return parse_commit_pages(read_json_lines(spark, path, S.COMMIT_PAGE))


def parse_commit_pages(pages: DataFrame) -> DataFrame:
    """One row per commit: first message line, author name and date; order = page, position."""
    items = pages.select(*S.FILE, "page", F.posexplode("commits").alias("pos", "c"))
    return items.select(
        *S.FILE,
        F.col("c.sha").alias("sha"),
        F.col("c.commit.author.name").alias("author_name"),
        F.get(F.split("c.commit.message", "\n"), 0).alias("message"),
        F.col("c.commit.author.date").alias("timestamp_raw"),
        parse_commit_time(F.col("c.commit.author.date")).alias("committed_at"),
        (F.col("page") * PAGE_STRIDE + F.col("pos")).cast("bigint").alias("ordinal"),
    )


def parse_commit_log(lines: DataFrame) -> DataFrame:
    """``sha|author|time|subject`` in ``value`` with its position in ``ordinal``.  The
    subject may hold further bars; lines with fewer than three are dropped."""
    parts = F.split("value", r"\x7C", 4)
    field = lambda i: strip(F.get("p", i))
    return (
        lines.select(*S.FILE, "ordinal", parts.alias("p"))
        .where(F.size("p") == 4)
        .select(
            *S.FILE,
            field(0).alias("sha"),
            field(1).alias("author_name"),
            field(3).alias("message"),
            field(2).alias("timestamp_raw"),
            parse_commit_time(field(2)).alias("committed_at"),
            F.col("ordinal").cast("bigint").alias("ordinal"),
        )
    )


def read_commit_log(spark: SparkSession, path: str) -> DataFrame:
    """Landed logs as JSON lines ``{repo_id, commit_sha, path, log}``, ``log`` being the whole log
    text of one file; a file's log is at most 50 lines long by how it is taken."""
    logs = read_json_lines(spark, path, S.COMMIT_LOG)
    return parse_commit_log(
        logs.select(*S.FILE, F.posexplode(F.split("log", LINE_ENDS)).alias("ordinal", "value"))
    )


# identity -----------------------------------------------------------------------------------


def repo_id_from_remote(url: Column, directory_name: Column) -> Column:
    """Last ``owner/name`` of a remote URL.  A name with a dot does not match and falls back to
    the directory name."""
    found = F.regexp_extract(strip(url), r"[:/]([^/]+/[^/.]+?)(?:\.git)?\n?\z", 1)
    return F.coalesce(F.nullif(found, F.lit("")), directory_name)


def branch_or_head(branch: Column) -> Column:
    return F.coalesce(F.nullif(strip(branch), F.lit("")), F.lit("HEAD"))
