"""The driver contract without the optional part or a library that it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {0!r} or name in {0!r}:
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {1!r})
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries()) and "cohort_sharded" in e.queries()
assert not any(n.startswith("op") or n == "pipeline" for n in e.queries())
"""


@pytest.mark.parametrize("missing", [("corpus_pipeline", "cohortline.llm"), ("public_tokenizers",), ("xxhash",), ("regex",)])
def test_entry_without(missing):
    done = subprocess.run([sys.executable, "-c", CODE.format(missing, ROOT)], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
