"""The entry module without the training-data operators, or without what they import."""

import os
import shutil
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

LIST = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None  # as if the package were not installed
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert set(o) <= set(q)
print(len(q), sum(n.startswith("op") or n == "pipeline" for n in q))
"""


def _listed(folder, *missing):
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", LIST, *missing], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return tuple(map(int, done.stdout.split()))


def _copy(*without):
    folder = tempfile.mkdtemp(prefix="roadlens-entry-", dir="/tmp")
    shutil.copytree(os.path.join(REPO, "roadlens"), os.path.join(folder, "roadlens"),
                    ignore=shutil.ignore_patterns("__pycache__", *without))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and os.path.exists(os.path.join(REPO, name)):
            shutil.copy(os.path.join(REPO, name), folder)
    return folder


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_training_data_operators(without):
    from roadlens.plans.registry import QUERIES

    assert _listed(_copy(*without)) == (len(QUERIES), 0)


@pytest.mark.parametrize("missing", ["zstandard", "xxhash", "public_tokenizers"])
def test_entry_without_a_package(missing):
    from roadlens.plans.registry import QUERIES

    n, extra = _listed(_copy(), missing)
    assert n - extra == len(QUERIES)
