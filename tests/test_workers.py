"""Queries with Python functions on workers whose import path does not hold the package."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
import __spark_entry__ as e
absent = spark.range(1).mapInPandas(lambda fs: (f.assign(id=__import__("importlib.util").util.find_spec("tessitura") is None) for f in fs), "id boolean").first()[0]
assert absent, "the workers see the package"
found = e.queries()
for name in {names!r}:
    if name in found:
        assert found[name](spark, {sf!r}).count() > 0, name
print("DONE")
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_workers_without_the_package(tmp_path):
    names = ["fbank", "cluster_threshold", "job_answers", "op1_suffix_dedup", "op2_decontaminate", "op3_language_id", "op4_secrets", "op6_quality", "op7_embedding_dedup", "op8_simhash", "op10_html_extract"]
    (tmp_path / "run.py").write_text(SCRIPT.format(root=ROOT, shared=str(tmp_path / "shared"), names=names, sf=SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "DONE" in done.stdout, done.stderr[-3000:]
