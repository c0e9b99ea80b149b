"""The library stands without its training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from corpusflow.checks import ORACLES, QUERIES

ROOT = Path(__file__).parent.parent


@pytest.fixture(params=["with corpus_pipeline.py", "without"])
def tree(request, tmp_path):
    """A copy of the repository without both folders of the training-data operators."""
    skip = shutil.ignore_patterns("llm", "__pycache__", ".*")
    for folder in ("corpusflow", "tests"):
        shutil.copytree(ROOT / folder, tmp_path / folder, ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "pyproject.toml"):
        if (ROOT / name).exists() and (name != "corpus_pipeline.py" or request.param.startswith("with ")):
            shutil.copy(ROOT / name, tmp_path)
    return tmp_path


def run(tree, *command):
    return subprocess.run([sys.executable, *command], cwd=tree, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})


def test_queries_without_the_folders(tree):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = run(tree, "-c", code)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], done.stderr[-500:]


def test_collection_without_the_folders(tree):
    done = run(tree, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert done.returncode == 0, done.stdout[-500:]
