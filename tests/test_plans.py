"""What the plans look like: JVM-side, pruned, and no file content in any shuffle."""

import re

import pytest

import __spark_entry__ as entry_point
from codestrata import session
from codestrata.catalog import fixtures as X
from codestrata.functions.times import instant
from codestrata.operators import resolve as R
from codestrata.plans import collection as C
from codestrata.plans.parse import parse_contents
from conftest import SF_DIR

FORBIDDEN = [
    "BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
    "CartesianProduct", "BroadcastNestedLoopJoin", "GlobalLimit 1000000",
]

TREE_ONLY = [
    "file_extension", "detect_language", "skip_reason", "source_files", "collectable_path", "cap_files",
    "path_depth", "path_hash", "language_distribution", "directory_structure", "max_depth", "test_directories",
    "first_readme", "first_manifest", "top_level_package", "entry_point_candidates", "changed_files",
    "target_files", "skip_reason_counts", "snapshot_head", "top_contributors", "latest_commit",
]

ONE_PASS = ["file_extension", "imports_js", "imports_all", "content_metrics", "readme_structure", "src_content_api_json"]

GROUP_LIMITED = ["cap_files", "commit_horizon_log", "top_contributors", "most_active_files", "largest_files",
                 "latest_artifact_per_file"]


def plan_of(df):
    execution = df._jdf.queryExecution()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return execution.explainString(mode)


def shuffled_columns(plan):
    """Input columns of every shuffle in a formatted plan."""
    return re.findall(r"^\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*)\]", plan, re.M)


@pytest.fixture(scope="module")
def plans(spark):
    names = sorted({*TREE_ONLY, *ONE_PASS, *GROUP_LIMITED})
    return {n: plan_of(entry_point.queries()[n](spark, SF_DIR)) for n in names}


def test_no_python_and_no_cross_products(plans):
    for name, plan in plans.items():
        assert [f for f in FORBIDDEN if f in plan] == [], name


@pytest.mark.parametrize("name", TREE_ONLY)
def test_text_is_not_read(plans, name):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plans[name])
    assert schemas and all("text:" not in s for s in schemas)


@pytest.mark.parametrize("name", ONE_PASS)
def test_per_row_queries_do_not_shuffle(plans, name):
    assert "Exchange" not in plans[name]


@pytest.mark.parametrize("name", GROUP_LIMITED)
def test_limits_apply_before_the_shuffle(plans, name):
    assert plans[name].count("WindowGroupLimit") >= 2


def test_parsing_is_map_only(spark):
    plan = plan_of(parse_contents(X.contents(spark, SF_DIR)))
    assert "Exchange" not in plan


def test_each_step_of_a_collection(spark, monkeypatch):
    """Every table a collection writes: no Python, no cross product, no content in a shuffle."""
    steps = {}

    def spy(df, name):
        steps[name] = plan_of(df)
        return session.materialize(df, name)

    monkeypatch.setattr(C, "materialize", spy)
    monkeypatch.setattr(R, "materialize", spy)
    result = C.full_collection(
        X.snapshots(spark, SF_DIR), X.tree(spark, SF_DIR), X.contents(spark, SF_DIR),
        X.commits(spark, SF_DIR), instant(X.AS_OF_30),
    )
    assert result.repos.count() == 20
    assert set(steps) == {
        "selected", "wanted", "parsed", "fetched", "requests", "bases", "edges", "activity", "records", "entries", "repos"
    }
    for name, plan in steps.items():
        assert [f for f in FORBIDDEN if f in plan] == [], name
        for columns in shuffled_columns(plan):
            assert not re.search(r"\b(text|content|raw_content)#", columns), (name, columns)
    # only the names' bits are summed and sent around beside the texts
    assert "BroadcastHashJoin" in steps["parsed"] and "SortMergeJoin" not in steps["parsed"]
    # after the parse nobody reads the texts again
    assert all("text:string" not in p for n, p in steps.items() if n != "parsed")
