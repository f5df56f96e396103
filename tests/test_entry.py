"""The entry module without the optional parts: the rest is there and complete."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, '.')
import __spark_entry__ as e
from demandloom.plans.catalog import QUERIES
from demandloom.plans.oracle import ORACLE
q, s = e.queries(), e.oracle_sql()
assert set(QUERIES) <= set(q) and set(ORACLE) <= set(s)
assert set(s) <= set(q)
print('pipeline' in q, any(k.startswith('op') and k[2].isdigit() for k in q))
"""


@pytest.mark.parametrize(
    ("gone", "printed"),
    [
        (["demandloom/llm", "tests/llm", "corpus_pipeline.py"], "False False"),
        (["demandloom/llm", "tests/llm"], "False False"),
    ],
)
def test_without_the_corpus_folders(tmp_path, gone, printed):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *[os.path.basename(g) for g in gone]))
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip() == printed
