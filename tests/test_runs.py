"""Runs on storage: manifests, publication, recovery, lookup, strict decoding; the newest view; kept-up edges."""

import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from codestrata import schemas as S
from codestrata.functions.times import instant
from codestrata.operators import live_edges as E
from codestrata.operators.resolve import resolve_imports
from codestrata.plans import collection as C
from codestrata.sources import artifacts as A
from codestrata.sources.runs import RunStore
from codestrata.streaming import newest as N
from test_collection import AS_OF, FILES, tables
from test_plans import plan_of


@pytest.fixture(scope="module")
def collected(spark):
    heads, tree, contents, commits = tables(spark)
    return C.full_collection(heads, tree, contents, commits, instant(AS_OF)), contents


def texts(df):
    return sorted(map(str, df.collect()))


def test_whole_run_from_storage(spark, collected, tmp_path):
    result, contents = collected
    store = RunStore(spark, str(tmp_path))
    store.store(result, contents)
    repos, files = store.load("o/r", "c")
    assert set(S.FILE_RECORD.fieldNames()) <= set(files.columns) and set(S.REPO_RECORD.fieldNames()) <= set(repos.columns)
    got = {r.file_path: r.raw_content for r in files.collect()}
    assert got == {p: FILES[p] or "" for p in got} and set(got) == {r.file_path for r in result.files.collect()}
    names = result.files.columns
    assert texts(files.select(names)) == texts(result.files.select(names))
    assert texts(repos.select(result.repos.columns)) == texts(result.repos)
    filters = re.findall(r"PartitionFilters: \[(.*)\]", plan_of(files))
    assert len(filters) == 1 and all(c in filters[0] for c in ("run#", "repo_id#", "commit_sha#"))
    for name in ("edges", "entries", "errors", "rejects", "parts"):
        assert texts(store.table(name).drop("run")) == texts(getattr(result, name)), name


def test_lookup_is_exact(spark, collected, tmp_path):
    result, _ = collected
    store = RunStore(spark, str(tmp_path))
    store.store(result)
    other = C.full_collection(*tables(spark, {"a.py": "import os\n"}, "123456", "o/r2"), instant(AS_OF))
    more = C.full_collection(*tables(spark, {"a.py": "import os\n"}, "123999", "o/r2"), instant(AS_OF))
    store.store(other)
    store.store(more)
    assert store.load("o/r2", "1234")[0].first().commit_sha == "123456"  # a text, though it looks like a number
    with pytest.raises(FileNotFoundError):
        store.load("o/r", "9")
    with pytest.raises(ValueError):
        store.load("o/r2", "123")
    assert store.newest("repos").count() == 3


def test_stopped_run_shows_as_running_and_is_taken_up_again(spark, collected, tmp_path, monkeypatch):
    result, contents = collected
    store = RunStore(spark, str(tmp_path))
    first = store.store(result, contents)
    number = store.begin(result)

    def stop(table, name, *args, **kwargs):
        if name == "entries":
            raise RuntimeError("stopped")
        return put(table, name, *args, **kwargs)

    put = store._put
    monkeypatch.setattr(store, "_put", stop)
    with pytest.raises(RuntimeError):
        store.write(result, number, contents)
    monkeypatch.undo()
    after = RunStore(spark, str(tmp_path))  # another reader
    status = {r.run: (r.status, r.completed_at is None) for r in after.manifest().collect()}
    assert status == {first: ("complete", False), number: ("running", True)}
    assert after.open_runs() == [number] and after.published() == [first]
    assert after.table("files").select("run").distinct().collect()[0].run == first  # half a run is not read
    after.resume(number, result, contents)
    assert after.open_runs() == [] and {r.status for r in after.manifest().collect()} == {"complete"}
    assert after.newest("files").count() == result.files.count()
    with pytest.raises(ValueError):
        after.resume(number, result)


def test_decoding_refuses_missing_and_extra_keys(spark, collected, tmp_path):
    result, contents = collected
    names = result.files.select(*S.KEY, F.col("file_path").alias("path"))
    from codestrata.plans.facts import with_content

    records = with_content(result.files, contents.join(names, S.FILE, "left_semi"))
    A.write_json_artifacts(records, S.FILE_RECORD, str(tmp_path))
    back = A.read_json_artifacts(spark, str(tmp_path), S.FILE_RECORD, strict=True)
    assert back.columns == S.FILE_RECORD.fieldNames() and back.count() == result.files.count()
    assert {r.file_path: r.raw_content for r in back.collect()} == {r.file_path: r.raw_content for r in records.collect()}
    good = A.read_json_lines(spark, str(tmp_path)).limit(1)
    for bad in (F.regexp_replace("value", '"language":"[a-z]+",', ""), F.regexp_replace("value", "^\\{", '{"more":1,'), F.lit("[1]")):
        with pytest.raises(PySparkException):
            A.parse_record_json(good.select(bad.alias("value")), S.FILE_RECORD, "value", strict=True).collect()
    repos = A.record_json(result.repos, S.REPO_RECORD)
    again = A.parse_record_json(repos, S.REPO_RECORD, strict=True)
    assert texts(again) == texts(result.repos.select(S.REPO_RECORD.fieldNames()))


def records(spark, rows):
    return spark.createDataFrame(rows, "repo_id string, file_path string, commit_sha string, run_at int, v int")


def test_newest_view_takes_deltas_only(spark, tmp_path, monkeypatch):
    view = N.files_view(spark, str(tmp_path), deltas=3)
    read = lambda: {(r.repo_id, r.file_path): r.v for r in view.read().collect()}
    view.append(records(spark, [("o/r", f"f{i}", "c1", 1, 1) for i in range(50)]), 0)
    view.append(records(spark, [("o/r", "f3", "c2", 2, 2), ("o/q", "a", "d", 2, 2)]), 1)
    assert spark.read.parquet(f"{tmp_path}/files/deltas/version=1").count() == 2  # its change and nothing else
    want = {("o/r", f"f{i}"): 1 for i in range(50)} | {("o/r", "f3"): 2, ("o/q", "a"): 2}
    assert read() == want
    view.append(records(spark, [("o/r", "f3", "c2", 2, 2), ("o/q", "a", "d", 2, 2)]), 1)  # played again
    assert read() == want and view.switch()[2] == [0, 1]
    # a writer that stops before the switch has changed nothing
    monkeypatch.setattr(view, "_turn", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        view.append(records(spark, [("o/r", "f4", "c3", 3, 3)]), 2)
    with pytest.raises(RuntimeError):
        view.compact()
    monkeypatch.undo()
    assert read() == want
    view.append(records(spark, [("o/r", "f4", "c3", 3, 3)]), 2)
    view.append(records(spark, [("o/r", "f4", "c0", 0, 9)]), 3)  # arrives late: an older run
    want[("o/r", "f4")] = 3
    assert read() == want and view.switch()[1:] == (3, [])  # four deltas became a base
    view.append(records(spark, [("o/r", "f4", "c0", 0, 9)]), 3)  # played again after that
    view.clean()
    assert read() == want and N.files_view(spark, str(tmp_path)).read().count() == 51


def test_edges_are_kept_up_by_each_commit(spark):
    """After every commit the edges equal those of all files resolved anew."""
    commits = [
        {"app.js": ["./lib", "./x", "pkg.m"], "lib/index.js": ["../app"], "x/index.js": [], "pkg/m.py": []},
        {"lib.js": ["./x.js"], "app.js": ["./lib", "./x", "pkg.m"], "x.js": []},  # added: earlier candidates of unchanged imports
        {"x.js": None, "lib/index.js": ["./../x", "../lib"], "pkg/m.py": None, "pkg/m/__init__.py": []},  # deleted and changed
        {"lib.js": None, "app.js": None, "z.js": ["./x/", "/lib"]},
    ]
    schema = "repo_id string, commit_sha string, path string, internal array<string>"
    now, state = {}, None
    for i, change in enumerate(commits):
        before = dict(now)
        now = {p: t for p, t in (now | change).items() if t is not None}
        kinds = [("o/r", p, "deleted" if t is None else "modified" if p in before else "added") for p, t in change.items()]
        files = lambda names: spark.createDataFrame([("o/r", "c", p, now[p]) for p in names], schema)  # noqa: E731, B023
        if state is None:
            state = E.start(files(now), files(now))
        else:
            changed = spark.createDataFrame(kinds, "repo_id string, path string, change string")
            state = E.advance(state, changed, files([p for p, t in change.items() if t is not None]))
        whole = resolve_imports(files(now), files(now).select(*S.FILE)).select("repo_id", "path", "import", "target")
        got = state.edges.select("repo_id", "path", "import", "target").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, whole.collect())), i
        assert len(got) > (0 if i else 2) or i == 3
        assert E.live_dependents(state).count() == len(got)
        state = E.LiveEdges(*[spark.createDataFrame(t.collect(), t.schema) for t in (state.paths, state.index, state.edges)])
