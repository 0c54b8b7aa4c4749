"""Without the training-data folders, the rest must import and work, whether the pipeline's file is there or not."""

import os
import shutil
import subprocess
import sys

import pytest


@pytest.mark.parametrize("pipeline", [True, False])
def test_rest_stands_alone(tmp_path, pipeline):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "decisionloom"), tmp_path / "decisionloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(os.path.join(root, "tests"), tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    if pipeline:
        shutil.copy(os.path.join(root, "corpus_pipeline.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'bm25_topk' in q and 'pipeline' not in q and not any(k.startswith('op') and k[2:3].isdigit() for k in q); assert set(e.oracle_sql()) <= set(q)"
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
    subprocess.run([sys.executable, "-m", "pytest", "-q", "--collect-only", "tests"], cwd=tmp_path, check=True, env=env, stdout=subprocess.DEVNULL)
    if pipeline:
        subprocess.run([sys.executable, "-m", "pytest", "-q", "tests/test_functions.py", "tests/test_small_parts.py"], cwd=tmp_path, check=True, env=env, stdout=subprocess.DEVNULL)
