"""Python stages must run when the workers cannot see the repository (as on a cluster)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
n = E.queries()["score_fixed_forest"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
"""


def test_pandas_udf_stage_runs_outside_the_repo():
    workdir = tempfile.mkdtemp(prefix="terracheck-ship-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=workdir, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS 1560" in out.stdout, out.stderr[-2000:]
