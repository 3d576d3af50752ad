"""The entry points without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_imports_without_the_subpackage(tmp_path, pipeline):
    """With and without the pipeline's file beside it; the other queries stay."""
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skipped)
    done = subprocess.run([sys.executable, "-B", "-c", SAY], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "ohlc_day" in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
