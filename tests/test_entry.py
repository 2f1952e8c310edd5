"""The entry works without the parts that may be taken out."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract
from skyledger.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]

BLOCKED = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("skyledger.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


def test_all_queries_are_there():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_import_without_the_optional_parts():
    said = subprocess.run(
        [sys.executable, "-c", BLOCKED], cwd=ROOT, capture_output=True, text=True, check=True
    )
    assert said.stdout.split() == [str(len(QUERIES))] * 2
