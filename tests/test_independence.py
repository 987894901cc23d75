"""The library without the training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LLM = os.path.join(ROOT, "martlake", "llm")

LISTED = """
import __spark_entry__ as entry
from martlake.plans.catalog import QUERIES
from martlake.plans.oracle import ORACLE_SQL
assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLE_SQL
"""


def _run(code: str, cwd: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True)


@pytest.fixture
def copy(tmp_path):
    def without(*left_out: str) -> str:
        target = tmp_path / "copy"
        skipped = {os.path.join(ROOT, x) for x in (".git", *left_out)}
        shutil.copytree(ROOT, target, ignore=lambda d, names: [n for n in names if os.path.join(d, n) in skipped or n == "__pycache__"])
        return str(target)

    return without


@pytest.mark.parametrize("left_out", [("martlake/llm", "tests/llm"), ("martlake/llm", "tests/llm", "corpus_pipeline.py")])
def test_all_other_queries_are_there(copy, left_out):
    found = _run(LISTED, copy(*left_out))
    assert found.returncode == 0, found.stderr


def test_tests_are_collected(copy):
    target = copy("martlake/llm", "tests/llm", "corpus_pipeline.py")
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=target, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout + found.stderr


@pytest.mark.skipif(not os.path.isdir(LLM), reason="needs the operators")
def test_other_import_errors_are_raised(copy):
    target = copy()
    with open(os.path.join(target, "martlake", "llm", "queries.py"), "a") as f:
        f.write("\nimport a_module_that_is_not_there\n")
    found = _run("import __spark_entry__ as e; e.queries()", target)
    assert found.returncode != 0 and "a_module_that_is_not_there" in found.stderr
