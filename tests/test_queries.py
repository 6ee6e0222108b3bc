import pytest

from gridloom.plans.queries import QUERIES, SQL

from . import against_duckdb


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, small, name):
    against_duckdb.check(spark, small, QUERIES[name], SQL[name])


def test_entry_counts_gaps(spark):
    import __spark_entry__

    found = __spark_entry__.entry(spark)
    assert found.columns == ["t", "total", "is_gap"]
    assert (found.count(), found.where("is_gap").count()) == (2405, 1311)


def test_entry_stands_without_the_llm_folder(tmp_path):
    """A copy of the repository without the subpackage still imports and registers the rest."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("__spark_entry__.py", "gridloom"):
        source = os.path.join(root, name)
        copy = shutil.copytree if os.path.isdir(source) else shutil.copy
        copy(source, tmp_path / name)
    shutil.rmtree(tmp_path / "gridloom" / "llm", ignore_errors=True)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
