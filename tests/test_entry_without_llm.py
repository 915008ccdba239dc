"""The entry from a copy of the repository without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
from riverbed.plans.catalog import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.abspath(E.__file__))


def names(folder):
    code = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": folder}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    queries, _, oracle = done.stdout.rpartition("NAMES")[2].partition("|")
    return set(queries.split()), set(oracle.split())


def test_entry_without_the_subpackage(tmp_path):
    """Without riverbed/llm, with or without corpus_pipeline.py: all other queries stay."""
    copy = str(tmp_path / "copy")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", ".hypothesis", ".pytest_cache"))
    assert names(copy) == (set(QUERIES), set(ORACLE))
    bare = str(tmp_path / "bare")
    shutil.copytree(copy, bare, ignore=shutil.ignore_patterns("corpus_pipeline.py", "__pycache__"))
    assert names(bare) == (set(QUERIES), set(ORACLE))


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "riverbed")):
        if "llm" in os.path.relpath(folder, ROOT).split(os.sep):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    text = f.read()
                assert "riverbed.llm" not in text and "from ..llm" not in text and "import llm" not in text, name
