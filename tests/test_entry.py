"""The driver contract holds with and without the removable text operators."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_the_text_operators(tmp_path, left_out):
    from variantlake.plans.queries import ORACLE, QUERIES

    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if "corpus_pipeline.py" not in left_out:
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    shutil.copytree(f"{ROOT}/variantlake", tmp_path / "variantlake", ignore=shutil.ignore_patterns(*left_out, "__pycache__"))
    told = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": ""})
    queries, oracle = json.loads(told.stdout)
    assert queries == sorted(QUERIES)
    assert oracle == sorted(ORACLE)
