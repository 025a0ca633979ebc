"""The warehouse stands alone: a copy without the training-data folders
imports, lists its queries and collects its tests."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", "*.md", "*.json"))
    for keep_pipeline in (True, False):
        if not keep_pipeline:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
                "assert len(q) > 100 and set(o) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q), sorted(q)")
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=copy,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stdout[-2000:]
