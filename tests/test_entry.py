"""The entry point with and without the optional part."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

WITHOUT = """
import importlib.abc, sys

class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "punctua.llm" or name.startswith("punctua.llm."):
            raise ModuleNotFoundError(name=name)

import importlib.util
real = importlib.util.find_spec
importlib.util.find_spec = lambda name, *more: None if name.startswith("punctua.llm") else real(name, *more)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
from workload.queries import QUERIES
from workload.oracle import SQL
assert set(entry.queries()) == set(QUERIES), set(entry.queries()) ^ set(QUERIES)
assert set(entry.oracle_sql()) == set(SQL)
print("fine")
"""


def test_entry_without_the_optional_part():
    """With the folder gone, but corpus_pipeline.py still there, the other queries register."""
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True)
    assert done.stdout.strip() == "fine", done.stderr
