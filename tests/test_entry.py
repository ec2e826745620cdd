"""The entry module without the training-data folders."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from tidemark import queries

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_imports_without_the_training_data_folders(tmp_path, left_out):
    """Also with an empty folder of that name, as version control or a cache may leave it."""
    queries.load_all()
    shutil.copytree(
        REPO, tmp_path / "repo", ignore=lambda folder, names: {n for n in names if n in left_out or n.startswith((".", "__pycache__"))}
    )
    asks = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    for empty in (False, True):
        if empty:
            (tmp_path / "repo" / "tidemark" / "llm").mkdir()
        said = subprocess.run([sys.executable, "-c", asks], cwd=tmp_path / "repo", capture_output=True, text=True)
        assert said.returncode == 0, said.stderr
        assert said.stdout.split() == [str(len(queries.BUILDERS)), str(len(queries.ORACLES)), "False"]
