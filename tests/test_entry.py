"""The entry works without the training-data subpackage, the pipeline, or both."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [["llm"], ["corpus_pipeline.py"], ["llm", "corpus_pipeline.py"]])
def test_entry_without_parts(tmp_path, gone):
    leave = shutil.ignore_patterns("__pycache__", ".git", *gone)
    copy = shutil.copytree(HERE, tmp_path / "repo", ignore=leave)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in e.queries()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONDONTWRITEBYTECODE": "1", "PYTHONPATH": ""})
    assert ran.returncode == 0, ran.stderr
    n, with_sql, dealt = ran.stdout.split()
    assert int(n) > 100 and int(with_sql) > 100
    assert dealt == str("llm" not in gone)
