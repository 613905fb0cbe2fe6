"""The registry stands without the training-data queries and what they import."""

import subprocess
import sys

import pytest

BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
names = e.queries()
assert "travel_by_state_month" in names and not any(n.startswith("op") for n in names), sorted(names)
assert set(e.oracle_sql()) <= set(names)
"""


@pytest.mark.parametrize("name", ["regex", "tokenizers", "corpus_pipeline", "arrivals.llm"])
def test_queries_without(name):
    subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
