"""The catalog stands alone where the optional subpackage is gone."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = "import __spark_entry__ as e; print(len(e.queries()), sorted(n for n in e.queries() if n.startswith('op') or n == 'pipeline'), len(e.oracle_sql()))"


def _shown(folder) -> str:
    return subprocess.run([sys.executable, "-c", PROGRAM], cwd=folder, capture_output=True, text=True, check=True).stdout


def test_catalog_without_the_subpackage(tmp_path):
    for pipeline in (True, False):
        copy = tmp_path / str(pipeline)
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
        if not pipeline and (copy / "corpus_pipeline.py").exists():
            os.remove(copy / "corpus_pipeline.py")
        names = _shown(copy)
        assert "[]" in names and int(names.split()[0]) > 80
