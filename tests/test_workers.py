"""Python workers must not need this package on their path (executors of a
cluster usually do not have it): the ledger fold runs from a driver whose
working directory is elsewhere."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
from tessera.operators import folds
df = spark.createDataFrame([("a", 1, "deposit", 100), ("a", 2, "withdraw", 150), ("a", 3, "withdraw", 60)],
                           "acct string, seq long, kind string, amount long")
print("RESULT", folds.ledger(df, "acct", ["seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"]).collect())
"""


def test_ledger_runs_without_package_on_worker_path():
    cwd = tempfile.mkdtemp(prefix="tessera-worker-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=300)
    assert "RESULT" in out.stdout, out.stderr[-2000:]
    assert "balance=40" in out.stdout and "n_rejected=1" in out.stdout
