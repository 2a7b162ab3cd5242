import shutil
import subprocess
import sys

from codestrata.catalog import all_queries
from conftest import ROOT


def run(code, folder):
    subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, check=True, timeout=120)


def test_entry_point_imports_without_a_session():
    run("import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); assert len(e.oracle_sql()) > 80", ROOT)


def test_entry_point_without_the_operators_subpackage(tmp_path):
    """Gone, gone but for an empty folder, or there but not to be imported: the library's own queries stay."""
    names = sorted(all_queries()[0])
    code = f"import __spark_entry__ as e; assert sorted(e.queries()) == {names!r} == sorted(e.oracle_sql())"
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "*.json"))
    run(code, copy)
    folder = copy / "codestrata" / "llm"
    folder.mkdir()
    run(code, copy)
    (folder / "__init__.py").write_text("import no_such_module_of_any_name\n")
    run(code, copy)
