"""The driver's contract, with and without the training-data operators."""

import os
import subprocess
import sys

from conftest import ROOT

import __spark_entry__ as entry

CODE = """
import sys
for name in ("hazgrid.llm", "corpus_pipeline"):
    sys.modules[name] = None  # as if deleted
import __spark_entry__ as entry
assert "mart_risk_zones" in entry.queries() and "pipeline" not in entry.queries()
assert not [n for n in entry.queries() if n.startswith("op")]
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_training_data_operators():
    subprocess.run([sys.executable, "-c", CODE], check=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT})
