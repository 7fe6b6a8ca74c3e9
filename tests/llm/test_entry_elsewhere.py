"""Workers need no copy of the package: the entry is loaded in a process that
starts in another folder, and the training-data queries run on a small table."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
for name, query in entry.queries().items():
    if name.startswith("op") and name[2].isdigit() or name == "pipeline":
        print(name, query(spark, sys.argv[2]).count())
"""


@pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="driver tables not present")
def test_queries_run_from_another_folder(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    out = subprocess.run([sys.executable, str(script), str(REPO / "__spark_entry__.py"), SF], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert len(out.stdout.splitlines()) == 14
