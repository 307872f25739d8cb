"""The entry without the package for training data and its pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = """
import __spark_entry__ as entry
from corvane import catalogue
print(sorted(set(catalogue.queries()) ^ set(entry.queries())), sorted(set(catalogue.oracle_sql()) ^ set(entry.oracle_sql())))
"""


@pytest.mark.parametrize("gone", [("corvane/llm", "corpus_pipeline.py"), ("corvane/llm",), ("corpus_pipeline.py",)])
def test_entry_of_a_copy_without_the_package(tmp_path, gone):
    skipped = shutil.ignore_patterns("llm", "__pycache__") if "corvane/llm" in gone else shutil.ignore_patterns("__pycache__")
    shutil.copytree(os.path.join(ROOT, "corvane"), tmp_path / "corvane", ignore=skipped)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if "corpus_pipeline.py" not in gone:
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    shown = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True)
    assert shown.returncode == 0, shown.stderr
    assert shown.stdout.strip() == "[] []"
