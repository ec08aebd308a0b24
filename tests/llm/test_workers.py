"""Workers need neither this folder nor the package on their path."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1500]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.executor.memory", "1500m").config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.warehouse.dir", sys.argv[2] + "/w").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
for name in sorted(q for q in entry.queries() if q == "pipeline" or q.startswith("op") and q[2].isdigit()):
    print("ROWS", name, len(entry.queries()[name](spark, "/root/testdata/sf0.001").collect()), flush=True)
"""


@pytest.mark.parametrize("master", ["local[2]"])
def test_queries_without_the_package_on_the_workers_path(tmp_path, master):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_LOCAL_DIRS")}
    script = SCRIPT.replace("local-cluster[1,2,1500]", master)
    ran = subprocess.run([sys.executable, "-c", script, ROOT, f"file://{tmp_path}"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    rows = [line.split()[1:] for line in ran.stdout.splitlines() if line.startswith("ROWS")]
    assert len(rows) == 11 and all(int(n) > 0 for _, n in rows), ran.stderr[-3000:]
