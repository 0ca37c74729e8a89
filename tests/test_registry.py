"""The registry without the training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
names = e.queries()
assert len(names) > 50 and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert set(e.oracle_sql()) <= set(names)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", names["clean_profile"](spark, "/root/testdata/sf0.001").count())
"""


def test_core_works_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    hidden = shutil.ignore_patterns(".git", "llm", "__pycache__", "corpus_pipeline.py", "spark-warehouse")
    shutil.copytree(ROOT, copy, ignore=hidden)
    run = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "rows" in run.stdout


def test_core_works_with_the_pipeline_file_alone(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse"))
    run = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
