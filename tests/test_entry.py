"""The entry module where the corpus operators are not installed."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CHECK = """
import __spark_entry__ as entry
from catalog import ORACLES, QUERIES
assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLES
"""


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_queries_without_the_corpus_operators(tmp_path, with_pipeline):
    for name in ("catalog", "tunetables"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if with_pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", CHECK], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
