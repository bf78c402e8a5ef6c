"""The entry file lists the sync queries whatever the corpus subpackage lacks."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {0!r} or name == {0!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
from keyrelay.plans import registry
assert set(e.queries()) == set(registry.QUERIES) and set(e.oracle_sql()) == set(registry.QUERIES), sorted(e.queries())
print("LISTED", len(e.queries()))
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "xxhash", "regex", "zstandard", "keyrelay.llm", "corpus_pipeline"])
def test_queries_without_a_library_of_the_corpus(name):
    r = subprocess.run([sys.executable, "-c", BLOCKED.format(name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "LISTED" in r.stdout, r.stderr[-1500:]
