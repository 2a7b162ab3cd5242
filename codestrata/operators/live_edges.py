"""Import edges of whole repositories, kept up to date commit by commit.

Files that did not change can still resolve differently: an added file may be an earlier candidate of an import, and a deleted one may have
been its target.  So next to the edges stands a reverse index, from every path an import may mean to the importing file.  A commit looks
up only its added and deleted paths there, and resolves again only those imports and the ones of its changed files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.operators.resolve import import_requests
from codestrata.operators.skew import join_hot

REPO_FILE = ["repo_id", "path"]
IMPORT = [*REPO_FILE, "import"]


@dataclass
class LiveEdges:
    """State of all repositories: ``paths`` (repo_id, path), ``index`` (repo_id, candidate, path, import, probe) and ``edges`` (repo_id, path,
    import, target)."""

    paths: DataFrame
    index: DataFrame
    edges: DataFrame


def candidate_index(files: DataFrame) -> DataFrame:
    """Every path an import of ``files`` (key, path, internal) may mean, in the order they are tried."""
    requests = import_requests(files)
    suffixes = lambda s: F.array(*[F.lit(x) for x in s])
    tries = F.when(F.col("is_path"), suffixes(["", *C.PATH_SUFFIXES])).otherwise(suffixes(C.MODULE_SUFFIXES))
    tried = requests.select(*IMPORT, "base", F.posexplode(tries).alias("probe", "suffix"))
    return tried.select("repo_id", F.concat("base", "suffix").alias("candidate"), "path", "import", "probe")


def resolved(index: DataFrame, paths: DataFrame) -> DataFrame:
    """Edges of the imports in ``index``: the first candidate that exists."""
    there = paths.select("repo_id", F.col("path").alias("candidate"))
    hits = join_hot(index, there, ["repo_id", "candidate"], "inner")
    return hits.groupBy(*IMPORT).agg(F.min_by("candidate", "probe").alias("target"))


def start(tree: DataFrame, files: DataFrame) -> LiveEdges:
    """The state of a first commit: its ``tree`` and its ``files`` with their imports."""
    paths, index = tree.select(*REPO_FILE).distinct(), candidate_index(files)
    return LiveEdges(paths, index, resolved(index, paths))


def advance(state: LiveEdges, changed: DataFrame, files: DataFrame) -> LiveEdges:
    """The state after a commit.  ``changed`` (repo_id, path, change: added, modified, deleted) are the tree's changes, ``files`` the added and
    modified ones with their imports.  Both are read more than once."""
    added, deleted = (changed.where(F.col("change") == c).select(*REPO_FILE) for c in ("added", "deleted"))
    paths = state.paths.join(deleted, REPO_FILE, "left_anti").unionByName(added).distinct()
    kept = state.index.join(changed.select(*REPO_FILE), REPO_FILE, "left_anti")
    fresh = candidate_index(files)
    moved = added.unionByName(deleted).select("repo_id", F.col("path").alias("candidate"))
    stirred = kept.join(moved, ["repo_id", "candidate"], "left_semi").select(*IMPORT).distinct()
    again = kept.join(stirred, IMPORT, "left_semi").unionByName(fresh)
    untouched = state.edges.join(changed.select(*REPO_FILE), REPO_FILE, "left_anti").join(stirred, IMPORT, "left_anti")
    return LiveEdges(paths, kept.unionByName(fresh), untouched.unionByName(resolved(again, paths)))


def live_dependents(state: LiveEdges) -> DataFrame:
    """Dependents over whole repositories: ``repo_id, path, dependent``."""
    return state.edges.select("repo_id", F.col("target").alias("path"), F.col("path").alias("dependent"))
