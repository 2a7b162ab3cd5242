"""Whole collections on a small hand-made repository: both modes, incremental runs, streams."""

import datetime as dt
import functools
import re

import pytest
from pyspark.sql import functions as F

from codestrata import schemas as S
from codestrata.functions.times import instant
from codestrata.operators import structure
from codestrata.operators import validate as V
from codestrata.operators.latest import latest_artifact_per_file, repo_dependents
from codestrata.plans import collection as C
from codestrata.session import materialize
from codestrata.sources import stored
from codestrata.sources.stored import only_named
from codestrata.streaming import commits as T
from codestrata.streaming import newest

AS_OF = "2024-03-01T00:00:00Z"

FILES = {
    "README.md": "# Demo\n## Installation\n",
    "package.json": "{}",
    "pkg/__init__.py": "",
    "pkg/main.py": "import os\nimport pkg.util\nfrom .x import y\n",
    "pkg/util.py": "from pkg.main import go\n",
    "pkg/tiny.py": "import os",
    "pkg/broken.py": None,
    "pkg/tests/test_main.py": "import pkg.main\n",
    "index.js": "import './lib/a'\nimport x from 'y'\n",
    "lib/a.js": "require('../index'); require('./a'); require('./none')\n",
    "lib/big.js": "import 'z'\n",
    "src/x.kt": "fun main() {}\n",
}
SIZES = {"lib/big.js": 200_000}


def tables(spark, files=FILES, commit="c1", repo="o/r"):
    text = lambda p: files[p] or ""
    tree = spark.createDataFrame(
        [(repo, commit, p, f"tree-{p}", SIZES.get(p, len(text(p)))) for p in files], S.TREE
    )
    contents = spark.createDataFrame(
        [(repo, commit, p, files[p], f"blob-{p}" if files[p] is not None else "") for p in files], S.CONTENTS
    )
    day = lambda n: dt.datetime(2024, 3, 1) - dt.timedelta(days=n)
    rows = [("pkg/main.py", "s1", "ann", 1, 0), ("pkg/main.py", "s2", "bob", 40, 1),
            ("pkg/main.py", "s3", "bob", 50, 2), ("pkg/main.py", "s4", "old", 100, 3),
            ("index.js", "s5", "ann", 2, 0), ("lib/a.js", "s6", "cy", 60, 0)]
    commits = spark.createDataFrame(
        [(repo, commit, p, sha, who, f"msg {sha}", None, day(n), o) for p, sha, who, n, o in rows], S.COMMITS
    )
    heads = spark.createDataFrame([(repo, "main", commit, day(0))], S.SNAPSHOTS)
    return heads, tree, contents, commits


@pytest.fixture(scope="module")
def local(spark):
    return C.full_collection(*tables(spark), instant(AS_OF))


@pytest.fixture(scope="module")
def api(spark):
    return C.full_collection(*tables(spark), instant(AS_OF), mode="api")


def by_path(df):
    return {r.file_path: r for r in df.collect()}


def test_local_files(local):
    got = by_path(local.files)
    # empty, tiny and unreadable files are skipped, not failed
    assert set(got) == {"pkg/main.py", "pkg/util.py", "index.js", "lib/a.js", "src/x.kt"}
    main = got["pkg/main.py"]
    assert main.imports_raw == ["import os", "import pkg.util", "from .x import ..."]
    assert (main.imports_internal, main.imports_external, main.imports_unresolved) == (["pkg/util.py"], ["os"], [".x"])
    assert main.dependents == ["pkg/util.py"]
    assert (main.commit_frequency_90d, main.commit_frequency_30d, main.days_since_last_change) == (3, 1, 1)
    assert main.top_contributors == ["bob", "ann"]
    assert (main.most_recent_commit_sha, main.most_recent_commit_message) == ("s1", "msg s1")
    assert main.determined_by == ["commit_history", "file_content", "file_tree", "import_parse"]
    assert (main.blob_sha, main.line_count, main.relative_depth) == ("blob-pkg/main.py", 4, 1)
    assert main.is_entry_point_candidate and not main.is_in_test_directory
    assert got["lib/a.js"].imports_internal == ["index.js", "lib/a.js"]
    assert got["lib/a.js"].dependents == ["index.js", "lib/a.js"]
    kotlin = got["src/x.kt"]
    assert kotlin.parse_warnings == ["import extraction not supported for language: kotlin"]
    assert kotlin.days_since_last_change == -1 and kotlin.most_recent_commit_timestamp is None
    assert len(kotlin.could_not_determine) == 6 and kotlin.determined_by == ["file_content", "file_tree"]
    assert set(S.FILE_RECORD.names) - {"raw_content"} <= set(local.files.columns)


def test_local_repo(local):
    r = local.repos.first()
    assert (r.total_file_count, r.source_file_count, r.files_collected, r.files_skipped) == (12, 5, 5, 7)
    assert r.skip_reasons == {
        "empty_file": 3, "non_source_extension": 2, "path_component:tests": 1, "too_large": 1
    }
    assert r.language_distribution == {"python": 2, "javascript": 2, "kotlin": 1}
    assert r.directory_structure == {"pkg/": 2, "lib/": 1, "src/": 1}
    assert (r.has_readme, r.readme_length_chars, r.readme_headers) == (True, 23, ["Demo", "Installation"])
    assert (r.has_package_manifest, r.manifest_type) == (True, "npm")
    assert (r.has_test_directory, r.test_directories) == (True, ["pkg/tests/"])
    assert r.entry_point_candidates == ["index.js", "pkg/main.py"]
    assert r.most_active_files == ["index.js", "pkg/main.py", "lib/a.js", "pkg/util.py", "src/x.kt"]
    assert r.largest_files == ["pkg/main.py", "index.js", "lib/a.js", "pkg/util.py", "src/x.kt"]
    assert (r.commit_frequency_30d, r.max_directory_depth, r.collection_errors) == (2, 1, [])
    assert r.determined_by == ["commit_history", "file_tree", "readme"]
    assert set(S.REPO_RECORD.names) <= set(local.repos.columns)
    run = local.runs.first()
    assert (run.status, run.mode, run.files_attempted, run.files_succeeded, run.files_failed) == ("complete", "full", 8, 5, 0)
    assert run.run_name == "o__r__main__c1"
    before = local.running.first()
    assert (before.status, before.completed_at, before.files_attempted, before.files_succeeded) == ("running", None, 8, 0)


def test_api_mode(api):
    got = by_path(api.files)
    # own package unknown: absolute imports are external; tiny files are kept
    assert got["pkg/main.py"].imports_external == ["os", "pkg.util"]
    assert got["pkg/main.py"].dependents == [] and "pkg/tiny.py" in got
    r = api.repos.first()
    fail = "validation failed — hard: raw_content is empty — file content could not be fetched"
    assert r.collection_errors == [f"pkg/__init__.py: {fail}", f"pkg/broken.py: {fail}"]
    assert "empty_file" not in r.skip_reasons
    run = api.runs.first()
    assert (run.status, run.files_attempted, run.files_succeeded, run.files_failed) == ("partial", 8, 6, 2)
    broken = {x.file_path: x for x in api.rejects.collect()}["pkg/broken.py"]
    assert broken.blob_sha == "tree-pkg/broken.py"


def test_unreadable_commit_time_fails_the_file(spark):
    heads, tree, contents, commits = tables(spark)
    odd = commits.where("sha = 's5'").withColumns(
        {"sha": F.lit("s0"), "timestamp_raw": F.lit("b"), "ordinal": F.lit(9).cast("bigint"),
         "committed_at": F.lit(None).cast("timestamp")}
    )
    result = C.full_collection(heads, tree, contents, commits.unionByName(odd), instant(AS_OF))
    assert "index.js" not in by_path(result.files)
    assert [r.error for r in result.errors.collect()] == ["Invalid isoformat string: 'b'"]
    # its imports still count: the file was read, only its record failed
    assert by_path(result.files)["lib/a.js"].dependents == ["index.js", "lib/a.js"]


def test_api_scope_and_cap(spark):
    result = C.full_collection(*tables(spark), instant(AS_OF), mode="api", max_files=2)
    got = by_path(result.files)
    assert set(got) == {"index.js", "lib/a.js"}
    repo = result.repos.first()
    assert repo.files_skipped == 4  # capped files do not count as skipped


def test_repository_without_source_files(spark):
    heads, tree, contents, commits = tables(spark, {"notes.txt": "x"})
    result = C.full_collection(heads, tree, contents, commits, instant(AS_OF))
    repo = result.repos.first()
    assert (repo.files_collected, repo.max_directory_depth, repo.language_distribution) == (0, 0, {})
    assert not repo.has_readme and repo.manifest_type is None and repo.determined_by == ["file_tree"]
    checked = V.validate_repos(result.repos).first()
    assert not checked.is_valid
    assert checked.issues == [
        "hard: source_file_count is zero — no source files were collected",
        "warning: no README found",
        "warning: no entry point candidates found",
    ]


def test_repo_skip_rate_text(local):
    issues = V.validate_repos(local.repos).first().issues
    assert issues == ["warning: high skip rate (58%) — 7 of 12 files were skipped"]


def test_incremental(spark):
    heads, tree, contents, commits = tables(spark)
    names = ["pkg/util.py", "gone.py", "README.md", "lib/a.js"]
    changed = spark.createDataFrame([("o/r", "c1", p) for p in names], "repo_id string, commit_sha string, path string")
    result = C.incremental_collection(heads, tree, contents, commits, changed, instant(AS_OF))
    got = by_path(result.files)
    assert set(got) == {"pkg/util.py", "lib/a.js"}
    # resolved against the whole tree, but only changed files count as dependents
    assert got["pkg/util.py"].imports_internal == ["pkg/main.py"]
    assert got["pkg/util.py"].dependents == [] and got["lib/a.js"].dependents == ["lib/a.js"]
    repo = result.repos.first()
    assert repo.skip_reasons == {"non_source_extension": 1, "not_in_tree": 1}
    assert (repo.total_file_count, repo.readme_headers) == (12, ["Demo", "Installation"])
    assert result.runs.first().mode == "incremental"


def test_contents_are_restricted_without_a_shuffle(spark):
    _, _, contents, _ = tables(spark)
    wanted = contents.where("path like 'lib/%'").select(*S.FILE)
    few = only_named(contents, wanted)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert few.columns == contents.columns and sorted(map(str, few.collect())) == sorted(map(str, contents.where("path like 'lib/%'").collect()))


def test_many_names_let_more_rows_pass_but_lose_none(spark, monkeypatch):
    monkeypatch.setattr(stored, "NAME_BITS", 64)
    rows = spark.range(2000).selectExpr("'o/r' as repo_id", "'c' as commit_sha", "concat('f', id) as path")
    wanted = rows.where("substring(path, 2) % 100 = 3")
    passed = only_named(rows, wanted)
    assert wanted.join(passed, S.FILE, "left_anti").count() == 0 and 20 <= passed.count() < 2000


def test_stored_contents_are_read_by_bucket(spark, tmp_path):
    heads, tree, contents, commits = tables(spark)
    stored.save_by_bucket(contents, f"{tmp_path}/contents", buckets=64)
    stored.save_by_bucket(tree, f"{tmp_path}/tree", stored.REPO_NAME, 16)
    kept = stored.read_by_bucket(spark, f"{tmp_path}/contents")
    wanted = contents.where("path in ('pkg/util.py', 'lib/a.js')").select(*S.FILE)
    few = only_named(kept, wanted)
    plan = few._jdf.queryExecution().executedPlan().toString()
    buckets = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S).group(1)
    numbers = {r[0] for r in wanted.select(stored.bucket_of(stored.FILE_NAME, 64)).distinct().collect()}
    assert len(numbers) == 2 and all(str(n) in buckets for n in numbers)
    read = {r[0] for r in stored.pruned(kept, wanted).select(F.input_file_name()).collect()}
    assert {int(re.search(r"bucket_of_64_repo_id_path=(\d+)", f).group(1)) for f in read} == numbers
    assert sorted(r.path for r in few.collect()) == ["lib/a.js", "pkg/util.py"]
    # a collection over stored tables gives the records of one over the plain ones
    names = ["pkg/util.py", "gone.py", "README.md", "lib/a.js"]
    changed = spark.createDataFrame([("o/r", "c1", p) for p in names], "repo_id string, commit_sha string, path string")
    plain = C.incremental_collection(heads, tree, contents, commits, changed, instant(AS_OF))
    other = C.incremental_collection(heads, stored.read_by_bucket(spark, f"{tmp_path}/tree").drop("bucket_of_16_repo_id"), kept, commits, changed, instant(AS_OF))
    for name in ("files", "repos", "runs"):
        assert sorted(map(str, getattr(plain, name).collect())) == sorted(map(str, getattr(other, name).collect())), name


def test_selection_comes_before_the_parse(spark, monkeypatch):
    """One file wanted: one text is parsed beside the README, and no file that is too large or skipped."""
    parsed = {}
    monkeypatch.setattr(C, "materialize", lambda df, name: parsed.setdefault(name, materialize(df, name)))
    heads, tree, contents, commits = tables(spark)
    result = C.full_collection(heads, tree, contents, commits, instant(AS_OF), "api", max_files=1)
    assert result.files.count() == 1
    assert sorted(r.path for r in parsed["parsed"].collect()) == sorted({result.files.first().file_path, structure.first_readme(tree).first().readme_path})


def test_long_lists_go_on_in_parts(spark):
    """With two entries a record every list beyond them is in the table of parts, in order and whole."""
    heads, tree, contents, commits = tables(spark)
    whole = C.full_collection(heads, tree, contents, commits, instant(AS_OF), "api")
    cut = C.collect_snapshots(heads, tree, contents, commits, instant(AS_OF), "api", part_rows=2)
    assert whole.parts.count() == 0
    more = {}
    for r in cut.parts.orderBy("part").collect():
        assert r.n == len(r["items"]) <= 2 and (r["first"], r["last"]) == (r["items"][0].value, r["items"][-1].value)
        more.setdefault((r.path, r.kind), []).extend(r["items"])
    assert more
    a, b = whole.repos.first().asDict(), cut.repos.first().asDict()
    for kind in ("test_directories", "entry_point_candidates", "collection_errors", "most_active_files", "largest_files"):
        assert b[kind] is not None and len(b[kind]) <= 2 and a[kind] == b[kind] + [x.value for x in more.get((None, kind), [])]
    for kind in ("language_distribution", "directory_structure", "skip_reasons"):
        assert len(b[kind]) <= 2 and a[kind] == b[kind] | {x.value: x.n for x in more.get((None, kind), [])}
    one, two = by_path(whole.files), by_path(cut.files)
    for path, r in one.items():
        assert r.dependents == two[path].dependents + [x.value for x in more.get((path, "dependents"), [])]
        assert r.n_dependents == two[path].n_dependents


# stream -------------------------------------------------------------------------------------


def land(spark, folder, rows):
    spark.createDataFrame(rows, S.COMMIT_TRIGGER).coalesce(1).write.mode("append").json(folder)


def test_stream(spark, tmp_path):
    """Two commits of one repository in two batches, a second repository, a broken trigger, and a
    trigger that arrives twice."""
    second = {**FILES, "pkg/util.py": "import sys\nimport pkg.main\n", "pkg/new.py": "import pkg.util\n"}
    del second["lib/a.js"], second["package.json"]
    parts = [tables(spark), tables(spark, second, "c2"), tables(spark, {"a.py": "import os\nimport a\n"}, "d1", "o/q")]
    _, tree, contents, commits = (
        parts[0][i].unionByName(parts[1][i]).unionByName(parts[2][i]) for i in range(4)
    )
    edited = F.when((F.col("commit_sha") == "c2") & (F.col("path") == "pkg/util.py"), F.lit("edited"))
    tree = tree.withColumn("sha", F.coalesce(edited, "sha"))
    landed = T.Tables(tree, contents, commits)
    day = lambda n: dt.datetime(2024, 3, n)
    base = str(tmp_path)

    def run():
        stream = T.start_collection_stream(
            T.read_triggers(spark, f"{base}/in"), landed, f"{base}/out", f"{base}/check",
            as_of=instant(AS_OF), latest_path=f"{base}/latest",
        )
        stream.awaitTermination()

    land(spark, f"{base}/in", [("o/r", "main", "c1", None, day(1)), ("o/x", "main", None, None, day(1))])
    run()
    land(spark, f"{base}/in", [("o/r", "main", "c2", "c1", day(2)), ("o/q", "main", "d1", "d0", day(2)),
                               ("o/r", "main", "c1", None, day(1))])
    run()
    read = lambda name: spark.read.parquet(f"{base}/out/{name}")
    runs = {r.commit_sha: (r.mode, r.files_attempted, r.files_succeeded) for r in read("runs").collect()}
    assert runs == {"c1": ("full", 8, 5), "c2": ("incremental", 2, 2), "d1": ("full", 1, 1)}
    skips = {r.commit_sha: r.skip_reasons for r in read("repos").collect()}
    assert skips["c2"] == {"not_in_tree": 1}  # the deleted source file; other names are not targets
    assert read("rejected_triggers").count() == 1
    latest = {(r.repo_id, r.file_path): r.commit_sha for r in spark.read.parquet(f"{base}/latest").collect()}
    assert latest == {
        ("o/r", "pkg/main.py"): "c1", ("o/r", "index.js"): "c1", ("o/r", "src/x.kt"): "c1",
        ("o/r", "lib/a.js"): "c1", ("o/r", "pkg/util.py"): "c2", ("o/r", "pkg/new.py"): "c2", ("o/q", "a.py"): "d1",
    }
    # over the whole repository, from the newest record of each file
    of = {(r.path, r.dependent) for r in repo_dependents(
        read("edges"), latest_artifact_per_file(read("files"))).where("repo_id = 'o/r'").collect()}
    assert of == {("pkg/main.py", "pkg/util.py"), ("pkg/util.py", "pkg/main.py"), ("pkg/util.py", "pkg/new.py"),
                  ("lib/a.js", "index.js"), ("index.js", "lib/a.js"), ("lib/a.js", "lib/a.js")}
    # a batch that is played again overwrites itself
    before = sorted(map(str, read("files").collect()))
    done = read("runs").where("batch_id < 1")
    again = spark.read.schema(S.COMMIT_TRIGGER).json(f"{base}/in").where("commit_sha in ('c2', 'd1')")
    result = T.collect_batch(again, landed, done, instant(AS_OF))
    T.store_batch(result, again, f"{base}/out", 1)
    T.upsert_latest(read("files").where("batch_id = 1").drop("batch_id"), f"{base}/latest")
    assert sorted(map(str, read("files").collect())) == before
    assert spark.read.parquet(f"{base}/latest").count() == len(latest)


def test_a_failing_repository_is_set_aside(spark, tmp_path, monkeypatch):
    """Four repositories in a batch, two of them with a text that cannot be parsed: the others are collected, and
    a replay gives the same."""
    repos = ["o/a", "o/b", "o/c", "o/d"]
    parts = [tables(spark, {"a.py": "import os\nimport a\n", "README.md": "# x\n"}, f"c{i}", r) for i, r in enumerate(repos)]
    tree, contents, commits = (functools.reduce(lambda x, y: x.unionByName(y), (p[i] for p in parts)) for i in (1, 2, 3))
    parse = C.parse_contents

    def stumbling(rows):
        broken = F.when(F.col("repo_id").isin("o/b", "o/d"), F.raise_error(F.lit("unreadable"))).otherwise(F.col("content"))
        return parse(rows.withColumn("content", broken.cast("string")))

    monkeypatch.setattr(C, "parse_contents", stumbling)
    landed = T.Tables(tree, contents, commits)
    base = str(tmp_path)
    land(spark, f"{base}/in", [(r, "main", f"c{i}", None, dt.datetime(2024, 3, 1)) for i, r in enumerate(repos)])

    def run(check):
        T.start_collection_stream(T.read_triggers(spark, f"{base}/in"), landed, f"{base}/out", f"{base}/{check}", as_of=instant(AS_OF), view_path=f"{base}/view").awaitTermination()
        found = {name: T.read_or_none(spark, f"{base}/out/{name}") for name in (*T.STORED, "set_aside", "started")}
        return {name: sorted(map(str, df.collect())) for name, df in found.items() if df is not None}

    first = run("check")
    read = lambda name: spark.read.parquet(f"{base}/out/{name}")
    assert {r.repo_id for r in read("runs").collect()} == {"o/a", "o/c"}
    aside = {r.repo_id: r.error for r in read("set_aside").collect()}
    assert set(aside) == {"o/b", "o/d"} and all("unreadable" in e for e in aside.values())
    # commits that were started and did not end: those set aside
    open_ = read("started").join(read("runs").select("repo_id"), "repo_id", "left_anti")
    assert {(r.repo_id, r.status) for r in open_.collect()} == {("o/b", "running"), ("o/d", "running")}
    assert run("check-again") == first  # the same batch once more
    view = newest.files_view(spark, f"{base}/view").read()
    assert {(r.repo_id, r.file_path) for r in view.collect()} == {("o/a", "a.py"), ("o/c", "a.py")}
    assert newest.repos_view(spark, f"{base}/view").read().count() == 2
    # mended and landed again, they are collected
    land(spark, f"{base}/in", [(r, "main", f"c{i}", None, dt.datetime(2024, 3, 1)) for i, r in enumerate(repos)])
    monkeypatch.undo()
    run("check-again")
    assert {r.repo_id for r in read("runs").collect()} == set(repos)
    assert newest.files_view(spark, f"{base}/view").read().count() == 4


def test_of_two_triggers_of_a_commit_always_the_same_counts(spark):
    rows = [("o/r", "main", "c", "p2", dt.datetime(2024, 3, 2)), ("o/r", "main", "c", "p1", dt.datetime(2024, 3, 1)), ("o/r", "x", "c", None, None)]
    for order in (rows, rows[::-1]):
        got = T.one_each(spark.createDataFrame(order, S.COMMIT_TRIGGER)).collect()
        assert len(got) == 1 and got[0].branch == "x"


def test_stream_result_equals_batch(spark):
    """One stream over a repository's first commit gives what the batch collection gives."""
    heads, tree, contents, commits = tables(spark)
    triggers = heads.withColumn("parent_sha", F.lit(None).cast("string"))
    streamed = T.collect_batch(triggers, T.Tables(tree, contents, commits), None, instant(AS_OF))
    batch = C.full_collection(heads, tree, contents, commits, instant(AS_OF))
    names = batch.files.columns
    assert sorted(map(str, streamed.files.select(names).collect())) == sorted(map(str, batch.files.collect()))
    names = batch.repos.columns
    assert sorted(map(str, streamed.repos.select(names).collect())) == sorted(map(str, batch.repos.collect()))
    assert streamed.runs.first().mode == "full"


def test_forced_full_run(spark):
    heads, tree, contents, commits = tables(spark)
    both = tree.unionByName(tree.withColumn("commit_sha", F.lit("c0")))
    triggers = heads.withColumn("parent_sha", F.lit("c0"))
    known = spark.createDataFrame([("o/r", "c0")], "repo_id string, commit_sha string")
    result = T.collect_batch(
        triggers, T.Tables(both, contents, commits), known, instant(AS_OF), force_full=True
    )
    assert (result.runs.first().mode, result.files.count()) == ("full", 5)


def test_batch_without_changes_is_a_no_op(spark):
    heads, tree, contents, commits = tables(spark)
    same = tree.unionByName(tree.withColumn("commit_sha", F.lit("c0")))
    triggers = heads.withColumn("parent_sha", F.lit("c0"))
    known = spark.createDataFrame([("o/r", "c0")], "repo_id string, commit_sha string")
    assert T.collect_batch(triggers, T.Tables(same, contents, commits), known) is None


def test_wanted_commits_are_made_once(spark, monkeypatch):
    """They are counted by file and then joined: both read what was written, and nothing makes the commits a second time."""
    heads, tree, contents, commits = tables(spark)
    lefts, join = [], C.join_hot
    monkeypatch.setattr(C, "join_hot", lambda left, *a, **k: lefts.append(left) or join(left, *a, **k))
    changed = tree.where("path in ('pkg/util.py', 'lib/a.js')").select(*S.FILE)
    found = C.incremental_collection(heads, tree, contents, commits, changed, instant(AS_OF))
    assert len(lefts) == 1 and all("/commits-" in f for f in lefts[0].inputFiles()) and lefts[0].inputFiles()
    assert found.files.count() == 2
