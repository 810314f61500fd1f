"""The entry without the training-data package: it imports and lists the other queries."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op') for k in q); print(len(q))"


def test_entry_without_the_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache"))
    for extra in ([], ["corpus_pipeline.py"]):  # with the pipeline's file left behind, and without it
        for name in extra:
            (copy / name).unlink(missing_ok=True)
        done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
        assert done.returncode == 0, done.stderr
        assert int(done.stdout) > 60
