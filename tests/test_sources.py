"""Landed files -> tables, and records through storage."""

import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from codestrata import schemas as S
from codestrata.operators import history as H
from codestrata.operators import selection as L
from codestrata.operators.latest import latest_artifact_per_file, latest_repo_header
from codestrata.functions.times import instant
from codestrata.sources import artifacts as A
from codestrata.sources import landing as D


def jsonl(path, rows):
    os.makedirs(path)
    with open(f"{path}/part.json", "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    return str(path)


def test_tree_json(spark, tmp_path):
    landed = {
        "repo_id": "o/r", "commit_sha": "c", "truncated": True,
        "tree": [
            {"path": "lib", "type": "tree", "sha": "t"},
            {"path": "lib/a.js", "type": "blob", "sha": "s1", "size": 7, "mode": "100644"},
            {"path": "b", "type": "blob", "sha": "s2"},
        ],
    }
    plain = {"repo_id": "o/q", "commit_sha": "c", "tree": []}
    path = jsonl(tmp_path / "t", [landed, plain])
    got = [tuple(r) for r in D.read_tree_json(spark, path).orderBy("path").collect()]
    assert got == [("o/r", "c", "b", "s2", 0, True), ("o/r", "c", "lib/a.js", "s1", 7, True)]
    responses = spark.read.schema(S.TREE_RESPONSE).json(path)
    assert [r.repo_id for r in D.truncated_trees(responses).collect()] == ["o/r"]


def test_broken_lines_fail_nothing(spark, tmp_path):
    path = jsonl(tmp_path / "b", [{"repo_id": "o/r", "commit_sha": "c", "path": "p", "content": "YQ==", "sha": "s"}])
    with open(f"{path}/more.json", "w") as f:
        f.write('{"repo_id": "o/q", "com\n[1, 2]\n')
    assert [r.content for r in D.read_content_json(spark, path).collect()] == ["a"]
    bad = D.unreadable_lines(spark, path, S.CONTENT_RESPONSE).collect()
    assert sorted(r.line for r in bad) == ["[1, 2]", '{"repo_id": "o/q", "com']
    assert all(r.file.endswith("more.json") for r in bad)


def test_tree_listing(spark, tmp_path):
    folder = tmp_path / "repo_id=o%2Fr" / "commit_sha=c"
    folder.mkdir(parents=True)
    (folder / "ls.txt").write_text(
        "100644 blob aa      12\tsrc/a b.py\n160000 commit bb       -\tsub\n100644 blob cc -\tx\n"
        "100644 blob dd\tshort\nno tab here\n100644 blob ee 5\tp\tq\n"
    )
    got = D.read_tree_listing(spark, str(tmp_path)).orderBy("path").collect()
    assert [tuple(r) for r in got] == [
        ("o/r", "c", "p\tq", "ee", 5), ("o/r", "c", "src/a b.py", "aa", 12), ("o/r", "c", "x", "cc", 0)
    ]


def test_content_json(spark, tmp_path):
    enc = lambda b: base64.encodebytes(b).decode()
    text = "é\r\n" * 100
    rows = [("a", enc(text.encode()), "s1"), ("b", enc(b"\xff\xfe"), "s2"), ("c", "", "s3"), ("d", "***", "s4")]
    path = jsonl(tmp_path / "c", [
        {"repo_id": "o/r", "commit_sha": "c", "path": p, "content": c, "sha": s} for p, c, s in rows
    ])
    got = {r.path: (r.content, r.blob_sha) for r in D.read_content_json(spark, path).collect()}
    assert got == {"a": (text, "s1"), "b": ("", "s2"), "c": ("", "s3"), "d": ("", "s4")}


def test_snapshot_files(spark, tmp_path):
    root = tmp_path / "repo_id=o%2Fr" / "commit_sha=c1"
    (root / "src").mkdir(parents=True)
    (root / "src" / "a.py").write_bytes(b"x\r\ny\rz\n")
    (root / "bad.py").write_bytes(b"\xff\xfe")
    (root / "empty.py").write_bytes(b"")
    got = {r.path: tuple(r) for r in D.read_snapshot_files(spark, str(tmp_path)).collect()}
    assert got["src/a.py"][:4] == ("o/r", "c1", "src/a.py", "x\ny\nz\n")
    import hashlib

    assert got["src/a.py"][4] == hashlib.sha1(b"blob 7\x00x\r\ny\rz\n").hexdigest()
    assert got["bad.py"][3:] == ("", "")
    assert "empty.py" not in got  # no row: collected like any file without content, with the tree's id


def test_commit_pages(spark, tmp_path):
    commit = lambda sha, msg, date: {
        "sha": sha, "commit": {"message": msg, "author": {"name": "A", "date": date}}
    }
    pages = [
        {"repo_id": "o/r", "commit_sha": "c", "path": "p", "page": 2,
         "commits": [commit("s3", "third", "2024-01-01T00:00:00Z")]},
        {"repo_id": "o/r", "commit_sha": "c", "path": "p", "page": 1,
         "commits": [commit("s1", "first\nbody", "2024-01-02T00:00:00Z"),
                     commit("s2", "", "2024-01-03T00:00:00+02:00")]},
    ]
    got = D.read_commit_pages(spark, jsonl(tmp_path / "p", pages)).orderBy("ordinal").collect()
    assert [(r.sha, r.message, r.author_name) for r in got] == [("s1", "first", "A"), ("s2", "", "A"), ("s3", "third", "A")]
    # list order, not time, decides what is latest
    latest = H.latest_commit(D.read_commit_pages(spark, str(tmp_path / "p"))).first()
    assert latest.most_recent_commit_sha == "s1"
    assert latest.most_recent_commit_timestamp_raw == "2024-01-02T00:00:00Z"


def test_commit_log(spark, tmp_path):
    log = (
        "s1|Ann|2024-01-02 00:00:00 +0000|fix a|b|c\n"
        "s2|Bo|b|2024-01-01 00:00:00 +0000|shifted\n"
        "s3|Cy|2024-01-01 00:00:00 +0100\n\n"
        " s4 | Di | 2024-01-01 00:00:00 +0100 | spaced \n"
    )
    path = jsonl(tmp_path / "l", [{"repo_id": "o/r", "commit_sha": "c", "path": "p", "log": log}])
    got = D.read_commit_log(spark, path).orderBy("ordinal").collect()
    assert [(r.sha, r.author_name, r.message, r.committed_at is None) for r in got] == [
        ("s1", "Ann", "fix a|b|c", False), ("s2", "Bo", "2024-01-01 00:00:00 +0000|shifted", True),
        ("s4", "Di", "spaced", False),
    ]
    assert got[2].timestamp_raw == "2024-01-01 00:00:00 +0100"


def test_heads(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("r", "main", "a", t), ("r", "main", "b", t + dt.timedelta(1)), ("r", "dev", "c", t),
            ("q", "main", None, t)]
    df = spark.createDataFrame(rows, S.struct(repo_id=S.TEXT, branch=S.TEXT, commit_sha=S.TEXT, committed_at=S.TIME))
    heads = L.snapshot_head(df)
    usable, missing = L.split_heads(heads)
    assert sorted((r.repo_id, r.branch, r.commit_sha) for r in usable.collect()) == [("r", "dev", "c"), ("r", "main", "b")]
    assert [(r.repo_id, r.commit_sha) for r in missing.collect()] == [("q", None)]


def test_changed_files_and_targets(spark):
    tree = lambda rows: spark.createDataFrame(
        [("r", "h", *x) for x in rows], "repo_id string, commit_sha string, path string, sha string, size bigint"
    )
    old = tree([("a.py", "1", 5), ("b.py", "1", 5), ("gone.py", "1", 5)])
    new = tree([("a.py", "1", 5), ("b.py", "2", 5), ("new.md", "1", 5), ("big.py", "9", 200_000)])
    changed = L.changed_files(old, new, S.FILE)
    assert {r.path: r.change for r in changed.collect()} == {
        "b.py": "modified", "gone.py": "deleted", "new.md": "added", "big.py": "added"
    }
    got = {r.path: r.skip_reason for r in L.target_files(changed, new).collect()}
    assert got == {"b.py": None, "gone.py": "not_in_tree", "new.md": "non_source_extension", "big.py": "too_large"}


def test_collection_mode(spark):
    heads = spark.createDataFrame(
        [("a", "x", "p"), ("b", "y", "p"), ("c", "z", None)], "repo_id string, commit_sha string, parent_sha string"
    )
    known = spark.createDataFrame([("a",), ("a",), ("c",)], "repo_id string")
    modes = lambda **kw: {r.repo_id: r.mode for r in L.collection_mode(heads, known, **kw).collect()}
    assert modes() == {"a": "incremental", "b": "full", "c": "full"}
    assert set(modes(forced=True).values()) == {"full"}


# history ------------------------------------------------------------------------------------


def test_history_order_ties_and_cap(spark):
    at = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    rows = [("r", "c", "p", f"s{i:03}", a, f"m{i}", None, at(-i), i) for i, a in
            enumerate(["zed", "amy", "amy", "zed", "bob", "cat"] + ["late"] * 100)]
    commits = spark.createDataFrame(rows, S.COMMITS)
    as_of = instant("2024-01-01T00:00:00Z")
    assert H.commit_horizon(commits, as_of).count() == 91
    capped = H.commit_horizon(commits, as_of, newest=50)
    assert capped.count() == 50
    got = H.file_history(H.author_activity(capped, as_of), as_of).first()
    assert got.top_contributors == ["late", "zed", "amy"]
    assert (got.commit_frequency_90d, got.commit_frequency_30d) == (50, 31)
    assert (got.most_recent_commit_sha, got.days_since_last_change) == ("s000", 0)


# records on storage -------------------------------------------------------------------------

NOON = dt.datetime(2025, 6, 1, 12)


def file_row(**changes):
    row = dict(
        repo_id="owner/repo", commit_sha="a" * 40, file_path="lib/app.js", blob_sha="b" * 40,
        file_path_hash="0" * 12, schema_version="1.0.0", fetched_at=NOON, language="javascript",
        raw_content="const x = 'é';\n", line_count=2, char_count=15, size_bytes=16, imports_raw=["express"],
        imports_internal=[], imports_external=["express"], imports_unresolved=[], dependents=["a.js"],
        most_recent_commit_sha="c" * 40, most_recent_commit_timestamp=NOON,
        most_recent_commit_author="Alice", most_recent_commit_message="initial", commit_frequency_30d=3,
        commit_frequency_90d=7, days_since_last_change=5, top_contributors=["Alice", "Bob"],
        is_entry_point_candidate=False, is_in_test_directory=False, relative_depth=1,
        determined_by=["file_content", "commit_history"], parse_warnings=["w"], could_not_determine=[],
    )
    row.update(changes)
    return tuple(row[f.name] for f in S.FILE_RECORD.fields)


def test_file_record_round_trip(spark, tmp_path):
    rows = [file_row(), file_row(file_path="b.js", most_recent_commit_timestamp=None, could_not_determine=["x"]),
            file_row(repo_id="owner/other", fetched_at=NOON.replace(microsecond=250_000))]
    df = spark.createDataFrame(rows, S.FILE_RECORD)
    texts = [json.loads(r.json) for r in A.record_json(df, S.FILE_RECORD).collect()]
    assert list(texts[0]) == S.FILE_RECORD.names and len(texts[0]) == 31
    assert texts[0]["fetched_at"] == "2025-06-01T12:00:00+00:00"
    assert texts[1]["most_recent_commit_timestamp"] is None
    assert texts[2]["fetched_at"] == "2025-06-01T12:00:00.250000+00:00"
    assert texts[0]["raw_content"] == "const x = 'é';\n"
    A.write_json_artifacts(df, S.FILE_RECORD, str(tmp_path / "out"))
    back = A.read_json_artifacts(spark, str(tmp_path / "out"), S.FILE_RECORD)
    key = lambda r: (r.repo_id, r.file_path)
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)
    assert back.schema.simpleString() == S.FILE_RECORD.simpleString()


def test_repo_record_round_trip(spark):
    row = ("o/r", "a" * 40, "main", NOON, "1.0.0", 50, 23, {"javascript": 21, "python": 2}, {"lib/": 8}, 3,
           True, 1024, ["My Project"], False, None, False, [], ["index.js"], ["lib/router.js"], ["src/app.js"],
           42, 23, 27, {"non_source_extension": 20}, [], ["file_tree"])
    df = spark.createDataFrame([row], S.REPO_RECORD)
    text = A.record_json(df, S.REPO_RECORD)
    assert len(json.loads(text.first().json)) == 26
    assert json.loads(text.first().json)["manifest_type"] is None
    assert A.parse_record_json(text, S.REPO_RECORD).collect() == df.collect()


def test_commit_time_keeps_its_source_offset(spark):
    df = spark.createDataFrame([file_row()], S.FILE_RECORD).withColumn(
        "most_recent_commit_timestamp_raw", F.lit("2025-06-01T14:00:00+02:00")
    )
    text = json.loads(A.record_json(df, S.FILE_RECORD).first().json)
    assert text["most_recent_commit_timestamp"] == "2025-06-01T14:00:00+02:00"


def test_load_run(spark):
    df = spark.createDataFrame(
        [file_row(repo_id="o/r"), file_row(repo_id="foo/r2"), file_row(repo_id="o/r", commit_sha="z" * 40)],
        S.FILE_RECORD,
    )
    assert A.require_run(df, "o/r", "a" * 40).count() == 1
    with pytest.raises(FileNotFoundError):
        A.require_run(df, "o/r", "a" * 9 + "b")
    with pytest.raises(ValueError):
        A.require_run(df, "o/r", "")
    repo, files = A.load_collection(df, df, "o/r", "a" * 7)
    assert (repo.count(), files.count()) == (1, 1)
    with pytest.raises(FileNotFoundError):
        A.require_run(df, "r", "a" * 40)


def test_latest_record_per_file(spark):
    rows = [("r", "c1", "a", 1, "old"), ("r", "c2", "a", 2, "new"), ("r", "c1", "b", 1, "kept"), ("q", "c9", "a", 1, "own")]
    df = spark.createDataFrame(rows, "repo_id string, commit_sha string, file_path string, run_at int, raw_content string")
    got = latest_artifact_per_file(df)
    assert "raw_content" not in got.columns
    assert sorted(tuple(r)[:4] for r in got.collect()) == [("q", "c9", "a", 1), ("r", "c1", "b", 1), ("r", "c2", "a", 2)]
    gone = spark.createDataFrame([("r", "b")], "repo_id string, file_path string")
    assert latest_artifact_per_file(df, gone).count() == 2
    assert {r.repo_id: r.commit_sha for r in latest_repo_header(df.drop("file_path")).collect()} == {"r": "c2", "q": "c9"}


def test_bucketed_contents_stay_in_place(spark):
    rows = spark.range(200).selectExpr(
        "concat('r', id % 3) as repo_id", "concat('c', id % 2) as commit_sha", "concat('f', id) as path", "repeat('x', 50) as content"
    )
    A.save_contents(rows, "stored_contents", 4)
    facts = rows.select("repo_id", "commit_sha", F.col("path").alias("file_path"))
    from codestrata.plans.facts import with_content

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = with_content(facts, spark.table("stored_contents"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert len(exchanges) == 1, plan  # the records' side only
        assert joined.where("raw_content = repeat('x', 50)").count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
