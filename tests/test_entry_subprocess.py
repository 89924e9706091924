"""The driver imports __spark_entry__ from another working directory: every query, including the
one with a pandas function (exact kNN), must run without riskframe installed on the workers."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert len(m.entry(spark).collect()) > 0
assert len(m.queries()["smote_synthesize"](spark, "/root/testdata/sf0.001").collect()) > 0
print("SUBPROCESS-OK")
"""


def test_entry_and_pandas_query_from_other_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                             timeout=600)
    assert "SUBPROCESS-OK" in out.stdout, out.stderr[-3000:]
