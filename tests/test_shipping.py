import subprocess
import sys
import textwrap
from pathlib import Path


def test_workers_need_no_path(tmp_path):
    """A session of its own, started elsewhere and without PYTHONPATH, can run the package's Python functions."""
    root = Path(__file__).resolve().parent.parent
    code = f"""
        import sys
        sys.path.insert(0, {str(root)!r})
        from pyspark.sql import SparkSession
        from pyspark.sql import functions as F
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        from docmill.functions.text import nfkc
        from docmill.shipping import ship
        ship(spark)
        assert spark.sql("SELECT 'ﬁ' AS v").select(nfkc(F.col("v"))).first()[0] == "fi"
        print("fine")
    """
    env = {"PATH": "/usr/bin:/bin:/usr/local/bin", "HOME": str(tmp_path)}
    import os

    env |= {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "PATH", "SPARK_HOME")}
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "fine" in out.stdout, out.stderr[-2000:]
