"""Repository structure from the tree and from the collected files.

Everything per repository is an aggregate with map-side partial results or a per-row
expansion followed by one, so a repository holding most of the files is no single task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.functions import paths as P
from codestrata.operators.skew import first_rows
from codestrata.schemas import KEY


def tree_order(tree: DataFrame) -> Column:
    """Listing order: ``ordinal`` if the source has one, else byte order of the path."""
    return F.struct("ordinal", "path") if "ordinal" in tree.columns else F.struct("path")


def language_distribution(files: DataFrame) -> DataFrame:
    return files.groupBy(*KEY, "language").agg(F.count(F.lit(1)).alias("n_files"))


def directory_structure(files: DataFrame) -> DataFrame:
    """Every ancestor prefix with the number of collected files below it."""
    prefixes = files.select(*KEY, F.explode(P.ancestor_prefixes(F.col("path"))).alias("directory"))
    return prefixes.groupBy(*KEY, "directory").agg(F.count(F.lit(1)).alias("n_files"))


def max_depth(files: DataFrame) -> DataFrame:
    """Deepest collected file per repository; absent repositories count as 0 when joined."""
    return files.groupBy(*KEY).agg(F.max(P.depth(F.col("path"))).alias("max_directory_depth"))


def skip_reason_counts(flagged: DataFrame) -> DataFrame:
    """Skipped entries per reason; input carries ``skip_reason``."""
    return (
        flagged.where(F.col("skip_reason").isNotNull())
        .groupBy(*KEY, "skip_reason")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def test_directories(tree: DataFrame) -> DataFrame:
    """Distinct prefixes up to the first test-named directory, over the whole tree."""
    found = tree.select(*KEY, P.test_directory(F.col("path")).alias("test_directory"))
    return found.where(F.col("test_directory").isNotNull()).distinct()


def entry_point_candidates(files: DataFrame) -> DataFrame:
    return files.where(P.is_entry_point(F.col("path"))).select(*KEY, "path")


def first_readme(tree: DataFrame) -> DataFrame:
    """First README of the listing, in whatever directory."""
    return (
        tree.where(P.is_readme(F.col("path")))
        .groupBy(*KEY)
        .agg(F.min_by("path", tree_order(tree)).alias("readme_path"))
    )


def first_manifest(tree: DataFrame) -> DataFrame:
    """Ecosystem of the first manifest of the listing, even inside skipped directories."""
    return (
        tree.withColumn("_type", P.manifest_type(F.col("path")))
        .where(F.col("_type").isNotNull())
        .groupBy(*KEY)
        .agg(F.min_by("_type", tree_order(tree)).alias("manifest_type"))
    )


def top_level_package(tree: DataFrame) -> DataFrame:
    """Shortest depth-one directory with an ``__init__.py``; earliest in the listing on ties."""
    parts = F.split("path", "/")
    name = F.get(parts, 0)
    marker = (F.size(parts) == 2) & (F.get(parts, 1) == "__init__.py")
    return (
        tree.where(marker & ~name.isin(C.TEST_DIRECTORIES))
        .groupBy(*KEY)
        .agg(F.min_by(name, F.struct(F.length(name), tree_order(tree))).alias("package"))
    )


def most_active_files(files: DataFrame, n: int = C.TOP_FILES) -> DataFrame:
    """Files with most commits of the last 30 days; files without any qualify."""
    order = [F.col("commit_frequency_30d").desc(), F.col("path").asc()]
    return first_rows(
        files.select(*KEY, "path", "commit_frequency_30d"), KEY, order, n
    )


def largest_files(files: DataFrame, n: int = C.TOP_FILES) -> DataFrame:
    order = [F.col("line_count").desc(), F.col("path").asc()]
    return first_rows(files.select(*KEY, "path", "line_count"), KEY, order, n)


def repo_commit_frequency(files: DataFrame) -> DataFrame:
    """Sum over files: a commit touching three files counts three times."""
    return files.groupBy(*KEY).agg(F.sum("commit_frequency_30d").alias("commit_frequency_30d"))
