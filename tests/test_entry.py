"""The driver contract with and without the training-data parts."""

import os
import shutil
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = """
import __spark_entry__ as e
from tessera.plans.registry import ORACLE, QUERIES
print(sorted(set(e.queries()) - set(QUERIES)), set(QUERIES) <= set(e.queries()), set(e.oracle_sql()) >= set(ORACLE))
"""


@pytest.mark.parametrize("gone", [("tessera/llm",), ("tessera/llm", "corpus_pipeline.py")])
def test_entry_without_the_training_parts(scratch, gone):
    copy = f"{scratch}/copy"
    away = {os.path.join(TOP, g) for g in gone}
    shutil.copytree(TOP, copy, ignore=lambda folder, names: [
        n for n in names if n in (".git", "tests", "__pycache__") or os.path.join(folder, n) in away])
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True, timeout=120,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.stdout.split("\n")[0] == "[] True True", out.stderr
