"""The driver's contract: names, SQL, and a repository without the training-data folder."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata/sf0.001"


def test_names():
    import __spark_entry__ as e

    names = e.queries()
    assert set(e.oracle_sql()) <= set(names) and len(names) > 100 and all(map(callable, names.values()))


def test_without_the_training_data_folder(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".hypothesis"))
    code = "import __spark_entry__ as e; n = e.queries(); print(len(n), [k for k in n if k.startswith('op') and k[2].isdigit() or k == 'pipeline'], len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env={**os.environ, "PYTHONPATH": str(tmp_path / "r")}, capture_output=True, text=True, check=True).stdout.split(maxsplit=1)
    assert int(out[0]) > 90 and out[1].startswith("[]")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_flagship(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
