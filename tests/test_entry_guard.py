"""The entry module where the training-data subpackage cannot be imported."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys, warnings
warnings.simplefilter("error" if {strict} else "ignore")
sys.modules[{blocked!r}] = None
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from fieldwatch.plans import queries
assert set(entry.queries()) == set(queries.QUERIES) == set(entry.oracle_sql())
print("fleet only")
"""


@pytest.mark.parametrize("blocked", ["public_tokenizers", "fieldwatch.llm", "fieldwatch.llm.queries"])
def test_fleet_queries_survive_a_missing_import(blocked):
    run = lambda strict: subprocess.run(
        [sys.executable, "-c", CODE.format(blocked=blocked, root=ROOT, strict=strict)], capture_output=True, text=True,
        timeout=120)
    done = run(False)
    assert "fleet only" in done.stdout, done.stderr[-2000:]
    assert "no training-data queries" in run(True).stderr
