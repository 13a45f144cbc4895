"""What the entry registers when the corpus operators, or a library they need, are not there."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash_that_nobody_needs", "martloom.llm", "corpus_pipeline"])
def test_retail_queries_need_no_corpus_library(missing):
    told = f"""
import sys
sys.modules[{missing!r}] = None
from checks.queries import queries as retail
from __spark_entry__ import oracle_sql, queries
assert set(retail()) <= set(queries()) and set(oracle_sql()) <= set(queries())
print(len(queries()) - len(retail()))
"""
    done = subprocess.run([sys.executable, "-c", told], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    there = (ROOT / "martloom" / "llm" / "queries.py").is_file() and missing.startswith("xxhash")
    assert (int(done.stdout) > 0) == there


def test_errors_of_its_own_code_are_not_hidden():
    told = "import sys; sys.modules['martloom.plans.shared'] = None; import __spark_entry__"
    done = subprocess.run([sys.executable, "-c", told], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode != 0 and "martloom.plans.shared" in done.stderr
