import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_imports_without_the_text_operators(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "gold_daily_summary" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
