"""The entry works without the corpus operators and without what only they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

BLOCKED = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
print(len(entry.queries()), any(q.startswith("op1_") or q == "pipeline" for q in entry.queries()))
"""


def run(name):
    code = BLOCKED.format(name=name, root=str(ROOT))
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("name", ["starforge.llm", "corpus_pipeline", "xxhash", "ahocorasick"])
def test_corpus_operators_may_be_left_out(name):
    got = run(name)
    assert got.returncode == 0, got.stderr
    assert got.stdout.split()[1] == "False" and int(got.stdout.split()[0]) > 130


@pytest.mark.parametrize("name", ["starforge.operators.joins", "starforge.workload"])
def test_a_missing_module_of_the_rest_is_an_error(name):
    got = run(name)
    assert got.returncode != 0 and "ModuleNotFoundError" in got.stderr
