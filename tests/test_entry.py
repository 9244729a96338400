"""The entry stands without the optional subpackage and without libraries that only it needs."""

import subprocess
import sys

import pytest


@pytest.mark.parametrize("gone", ["xxhash", "fathomline.llm", "corpus_pipeline"])
def test_entry_without(gone):
    code = (f"import sys; sys.modules[{gone!r}] = None\nimport __spark_entry__ as e\nfrom fathomline.plans import catalogue\n"
            "assert set(e.queries()) == set(catalogue.QUERIES) and set(e.oracle_sql()) == set(catalogue.SQL)")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
