"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_module_imports_without_a_session():
    import subprocess
    import sys
    code = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         cwd=__import__("os").path.dirname(__import__("os").path.dirname(__file__)))
    assert out.returncode == 0, out.stderr[-2000:]


def test_python_backed_queries_run_from_another_directory(tmp_path):
    """Workers must get the package from the library itself (pickled by value
    / shipped), not from the working directory."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print(E.queries()['smoothed_slew'](spark, '/root/testdata/sf0.001').count())\n" % repo)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         cwd=str(tmp_path), timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().splitlines()[-1] == "1000"
