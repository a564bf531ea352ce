"""The Pandas UDF must work when the driver runs outside the repository (the package is
shipped to the Python workers, not found through the working directory)."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_holt_winters_query_from_another_directory(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        import __spark_entry__ as e
        print("ROWS", e.queries()["holt_winters_backtest"](spark, "/root/testdata/sf0.001").count())
        spark.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 6" in out.stdout, out.stderr[-2000:]
