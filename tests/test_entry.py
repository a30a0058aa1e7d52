"""The entry module works, with all other queries, where the training-data package is not there."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WITHOUT = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("bazaarlake.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

if sys.argv[1] == "without":
    sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), len([q for q in e.queries() if q.startswith("op") or q == "pipeline"]), set(e.oracle_sql()) <= set(e.queries()))
"""


def listed(mode):
    done = subprocess.run([sys.executable, "-c", WITHOUT, mode], cwd=ROOT, capture_output=True, text=True, check=True)
    return done.stdout.split()


def test_entry_without_the_package():
    count, ours, sound = listed("without")
    assert (ours, sound) == ("0", "True") and int(count) >= 125
