"""The entry module with and without the training-data subpackage; and that every query has its SQL under the same name."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def copied(tmp_path: Path, without: tuple[str, ...] = (), broken: str = "") -> str:
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", *without))
    if broken:
        with (tmp_path / "r" / broken).open("a") as f:
            f.write("\nimport isthmus.nowhere\n")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"], cwd=tmp_path / "r", capture_output=True, text=True, check=False)
    return run.stdout.strip() if run.returncode == 0 else run.stderr


def test_without_the_subpackage_the_other_queries_are_there(tmp_path):
    n = len([q for q in __spark_entry__.queries() if not q.startswith("op") and q != "pipeline"])
    assert copied(tmp_path, ("llm", "corpus_pipeline.py")) == f"{n} {n} False"


@pytest.mark.parametrize("module", ["isthmus/plans/units.py"])
def test_a_fault_is_not_hidden(tmp_path, module):
    assert "isthmus.nowhere" in copied(tmp_path, broken=module)


def test_every_relational_query_has_sql():
    sql = __spark_entry__.oracle_sql()
    assert all(q in sql for q in __spark_entry__.queries() if not q.startswith("op") and q != "pipeline") and set(sql) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 4
