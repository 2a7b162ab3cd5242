"""Import resolution and dependents on small trees."""

import random

import pytest

from codestrata.operators import resolve as R
from codestrata.operators import selection

TREE = [
    "lib/router.js", "lib/middleware/auth.js", "lib/middleware/logger.js", "lib/utils/index.js",
    "index.js", "app.js", "pkg/main.py", "pkg/sub/__init__.py", "pkg/both.py", "pkg/both/__init__.py",
    "web/a.ts", "web/a.js", "web/b.tsx", "web/b/index.js", "rb/x.rb",
]

# (file, import) -> target
CASES = {
    ("lib/express.js", "./router"): "lib/router.js",
    ("lib/middleware/auth.js", "../utils"): "lib/utils/index.js",
    ("lib/router.js", "./utils"): "lib/utils/index.js",
    ("lib/router.js", "./utils/"): "lib/utils/index.js",
    ("lib/router.js", "./middleware/auth"): "lib/middleware/auth.js",
    ("lib/router.js", "./middleware/auth.js"): "lib/middleware/auth.js",
    ("app.js", "./routes/users"): None,
    ("app.js", "'./dynamic-' + name"): None,
    ("app.js", "./${x}"): None,
    ("app.js", "./`x`"): None,
    ("app.js", "express"): None,
    ("app.js", "./"): None,
    ("app.js", "./index"): "index.js",
    ("app.js", "/lib/router"): "lib/router.js",
    ("lib/deep/x.js", "//lib/router.js"): "lib/router.js",
    ("app.js", "../app"): None,
    ("web/x.js", "./a"): "web/a.js",
    ("web/x.js", "./b"): "web/b.tsx",
    ("web/x.js", ".\\a"): None,
    ("web/x.js", "./..\\web\\a"): None,
    ("x.py", "pkg.main"): "pkg/main.py",
    ("x.py", "pkg.sub"): "pkg/sub/__init__.py",
    ("x.py", "pkg.both"): "pkg/both.py",
    ("pkg/x.py", ".main"): None,
    ("pkg/x.py", "..main"): None,
    ("rb/y.rb", "./x.rb"): "rb/x.rb",
    ("src/lib.rs", "crate::m"): None,
}


def files_df(spark, rows):
    return spark.createDataFrame(
        [("o/r", "c", p, i) for p, i in rows],
        "repo_id string, commit_sha string, path string, internal array<string>",
    )


def tree_df(spark, paths, repo="o/r"):
    return spark.createDataFrame(
        [(repo, "c", p) for p in paths], "repo_id string, commit_sha string, path string"
    )


@pytest.mark.parametrize("floor", [100_000, 1])
def test_resolution(spark, floor):
    """With floor 1 every repeated base path counts as hot and is salted."""
    by_file = {}
    for file, text in CASES:
        by_file.setdefault(file, []).append(text)
    tree = tree_df(spark, TREE).unionByName(tree_df(spark, ["app.js", "routes/users.js"], "other/r"))
    edges = R.resolve_imports(files_df(spark, list(by_file.items())), tree, floor).collect()
    assert {(e.path, getattr(e, "import")): e.target for e in edges} == {
        k: t for k, t in CASES.items() if t is not None
    }
    assert len(edges) == len({(e.path, getattr(e, "import")) for e in edges})


def test_file_lists(spark):
    files = files_df(
        spark,
        [("app.js", ["./index", "./no", "./index.js", "./no", "./app"]), ("lib/x.js", [])],
    )
    edges = R.resolve_imports(files, tree_df(spark, TREE))
    got = {r.path: r for r in R.attach_resolution(files, edges).collect()}
    assert got["app.js"].imports_internal == ["app.js", "index.js", "index.js"]
    assert got["app.js"].imports_unresolved == ["./no", "./no"]
    assert (got["lib/x.js"].imports_internal, got["lib/x.js"].imports_unresolved) == ([], [])
    misses = R.unresolved_imports(files, edges).orderBy("pos").collect()
    assert [(m.pos, getattr(m, "import")) for m in misses] == [(1, "./no"), (3, "./no")]
    # a file that imports itself is its own dependent; two spellings count twice
    lists, more = R.dependent_lists(edges)
    lists = {r.path: (r.n_dependents, r.dependents) for r in lists.collect()}
    assert more is None and lists == {"app.js": (1, ["app.js"]), "index.js": (2, ["app.js", "app.js"])}


def test_no_imports(spark):
    files = files_df(spark, [("app.js", [])])
    assert R.resolve_imports(files, tree_df(spark, TREE)).collect() == []


def test_scope(spark):
    tree, fetched = tree_df(spark, TREE), files_df(spark, [("app.js", ["./index"])])
    assert R.resolution_scope(tree, fetched, "local").count() == len(TREE)
    assert [r.path for r in R.resolution_scope(tree, fetched, "api").collect()] == ["app.js"]


def test_growing_tables_do_not_pass_through_the_driver(spark):
    """However small they look: their compressed size says little of what the driver would hold."""
    tree, files = tree_df(spark, TREE), files_df(spark, [("app.js", ["./index"]), ("web/x.js", ["./a"])])
    fetched = R.resolution_scope(tree, files, "api")
    edges = R.resolve_imports(files, tree)
    for made in (fetched, edges, R.attach_resolution(files, edges), R.unresolved_imports(files, edges)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_changed_files_by_digest(spark, monkeypatch):
    """Random pairs of trees: the rows of the plain comparison, from few of their rows."""
    rnd = random.Random(9)
    on, schema = ["repo_id", "path"], "repo_id string, path string, sha string"
    parent = {(f"o/r{i % 3}", f"d{i % 7}/e{i % 11}/f{i}"): "s" for i in range(2_000)} | {("o/r0", "top"): "s"}
    for n in (0, 1, 5):
        head = dict(parent)
        for name in rnd.sample(sorted(parent, key=str), n):
            if rnd.random() < 0.4:
                del head[name]
            else:
                head[name] = "t"
        head |= {("o/r1", f"new{i}/g/h"): "u" for i in range(n)}
        old, new = (spark.createDataFrame([(*k, s) for k, s in t.items()], schema) for t in (parent, head))
        digests = [selection.directory_digests(t, on) for t in (old, new)]
        looked = []
        plain = selection.changed_files
        monkeypatch.setattr(selection, "changed_files", lambda a, b, on: looked.append(a.count() + b.count()) or plain(a, b, on))
        got = selection.changed_files_by_digest(old, new, on, *digests)
        monkeypatch.undo()
        assert sorted(map(str, got.collect())) == sorted(map(str, plain(old, new, on).collect()))
        assert looked[0] <= n * 80


def test_changed_files_by_digest_of_whole_trees(spark):
    on, schema = ["repo_id", "path"], "repo_id string, path string, sha string"
    some, none = spark.createDataFrame([("o/r", "a/b", "s"), ("o/r", "c", "s")], schema), spark.createDataFrame([], schema)
    digests = {id(t): selection.directory_digests(t, on) for t in (some, none)}
    for old, new, change in ((none, some, "added"), (some, none, "deleted")):
        got = selection.changed_files_by_digest(old, new, on, digests[id(old)], digests[id(new)]).collect()
        assert sorted((r.path, r.change) for r in got) == [("a/b", change), ("c", change)]
