from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
CODE = """
import sys
for name in {missing}:
    sys.modules[name] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert names >= set(entry.oracle_sql())
print(sum(n.startswith("op") for n in names if n[2:3].isdigit()), "pipeline" in names, len(names) > 30)
"""


def names_without(*missing):
    run = subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    return run.stdout.strip()


def test_queries_with_and_without_the_subpackage():
    assert names_without() == "13 True True"
    assert names_without("tidemark.llm", "corpus_pipeline") == "0 False True"
    assert names_without("corpus_pipeline") == "0 False True"
