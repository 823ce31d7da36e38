"""The entry points work without the training-data subpackage, its pipeline, or anything these need."""

import subprocess
import sys

import pytest

PROGRAM = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in gone or name in gone:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

gone = set(sys.argv[1:])
sys.meta_path.insert(0, Absent())
import __spark_entry__

print(len(__spark_entry__.queries()), len(__spark_entry__.oracle_sql()), any(k.startswith("op") for k in __spark_entry__.queries()))
"""


@pytest.mark.parametrize("gone", [["tesselake.llm"], ["corpus_pipeline"], ["tesselake.llm", "corpus_pipeline"]])
def test_core_queries_load_without(gone):
    out = subprocess.run([sys.executable, "-c", PROGRAM, *gone], capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    found, oracles, ops = out.stdout.split()
    assert int(found) >= 60 and int(oracles) >= 60 and ops == "False"


@pytest.mark.parametrize("gone", ["public_tokenizers", "sentencepiece", "tokenizers"])
def test_queries_load_without_tokenizers(gone):
    out = subprocess.run([sys.executable, "-c", PROGRAM, gone], capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) >= 60
