"""The contract file without what the corpus operators need."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.modules["{hidden}"] = None
import __spark_entry__ as contract
names = set(contract.queries())
assert set(contract.oracle_sql()) <= names
print(len(names), any(n.startswith("op1") or n == "pipeline" for n in names))
"""


def registered(hidden):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, corpus = done.stdout.split()[-2:]
    return int(count), corpus == "True"


def test_other_queries_stay_without_the_corpus_operators():
    whole, corpus = registered("no_such_module")
    for hidden in ("wattlake.llm", "corpus_pipeline", "xxhash"):
        left, there = registered(hidden)
        assert not there and left == whole - 14 * corpus
