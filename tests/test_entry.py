"""The registered queries without the text operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_text_operators(tmp_path):
    """A copy that lacks the subpackage still registers all other queries, with and without the pipeline's file."""
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{REPO}/{name}"):
            shutil.copy(f"{REPO}/{name}", tmp_path)
    shutil.copytree(f"{REPO}/propgraph", tmp_path / "propgraph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(f"{REPO}/suite", tmp_path / "suite", ignore=shutil.ignore_patterns("__pycache__"))
    code = "import __spark_entry__ as e; from suite import all_queries; assert set(e.queries()) == set(all_queries()) >= set(e.oracle_sql())"
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
        assert done.returncode == 0, done.stderr
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
