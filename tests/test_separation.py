"""The library, its queries and the entry point without the training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
import __spark_entry__ as entry
names = set(entry.queries())
assert names and not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert set(entry.oracle_sql()) <= names
assert not [m for m in sys.modules if ".llm" in m or m == "corpus_pipeline"]
print(len(names))
"""


def test_entry_works_without_the_operators(tmp_path):
    for name in ("cabflow", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if not os.path.exists(source):
            continue
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    run = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) >= 121


def test_names_of_test_files_are_unique():
    names = [f for folder, _, files in os.walk(os.path.join(ROOT, "tests")) for f in files if f.startswith("test_")]
    assert len(names) == len(set(names))
