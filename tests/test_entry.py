"""The driver's contract holds without the corpus operators, also where the pipeline's file is left behind."""

import shutil
import subprocess
import sys

import pytest
from conftest import ROOT


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_stands_without_the_corpus_operators(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse"))
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.QUERIES) and set(e.oracle_sql()) == set(e.ORACLE)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
