"""The driver's contract holds without the subpackage for training text."""

import shutil
import subprocess
import sys
from pathlib import Path

from daybook.catalog import CHECKS, QUERIES

TOP = Path(__file__).resolve().parent.parent


def test_entry_without_the_subpackage(tmp_path):
    out = {}
    for pipeline in (True, False):
        copy = tmp_path / str(pipeline)
        shutil.copytree(TOP, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *[] if pipeline else ["corpus_pipeline.py"]))
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
        out[pipeline] = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert out[True] == out[False] == [str(len(QUERIES)), str(len(CHECKS)), "False"]
