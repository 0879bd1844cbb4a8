"""Python workers must not need the package on their path."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_with_python_workers_run_from_another_folder(tmp_path, data):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        import __spark_entry__ as entry
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").getOrCreate())
        for name in ("map_distinct", "merge_response", "compare_documents", "malformed_xml"):
            assert entry.queries()[name](spark, {data!r}).count() > 0, name
        print("done")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().endswith("done"), run.stderr[-2000:]
