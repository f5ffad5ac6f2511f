"""Task code must not depend on the caller's working directory: a fresh
process started elsewhere runs the Python-backed operators."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from ledgerline.operators.knn import exact_knn
from ledgerline.operators.generate import generate_text
c = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(20)], "id long, v array<double>")
q = spark.createDataFrame([(1, [3.2, 0.0])], "qid int, qv array<double>")
ids = [r.id for r in exact_knn(c, q, 2, corpus_id="id", corpus_vec="v", query_id="qid", query_vec="qv").orderBy("rank").collect()]
txt = generate_text(spark.createDataFrame([("a",)], "p string"), "p", "out", model=lambda s: s.str.upper()).collect()[0].out
print("RESULT", ids, txt)
"""


def test_python_operators_run_from_any_directory():
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, capture_output=True, text=True, timeout=300)
    assert "RESULT [3, 4] A" in out.stdout, out.stderr[-2000:]
