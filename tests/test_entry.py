"""The driver's contract, also without the training-data subpackage."""

import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_custkey", "l_returnflag", "l_extendedprice", "ship_day", "l_orderkey", "l_linenumber", "candidates"]
    assert df.count() > 0


def test_catalogue():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 80


def test_rest_imports_without_the_subpackage(tmp_path):
    for name in ("factloom", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", os.path.join(ROOT, name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "factloom" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'best_ship_price' in q and not any(k.startswith('op') and k[2].isdigit() for k in q); assert 'pipeline' not in q; e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
