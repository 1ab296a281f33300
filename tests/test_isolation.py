"""The library without the subpackage llm, with and without the pipeline's file."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROGRAM = """
import __spark_entry__ as e
names = set(e.queries())
assert names and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names), names
assert set(e.oracle_sql()) <= names
import pkgutil, importlib, textloom
for m in pkgutil.walk_packages(textloom.__path__, "textloom."):
    importlib.import_module(m.name)
"""


@pytest.mark.parametrize("with_pipeline_file", [True, False])
def test_without_llm(tmp_path, with_pipeline_file):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if with_pipeline_file else ["corpus_pipeline.py"])))
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path / "copy", capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
