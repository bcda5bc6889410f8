"""The library without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("without_pipeline", [True, False])
def test_entry_without_the_operators(tmp_path, without_pipeline):
    for name in ("stratamart", "suite", "__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif not (without_pipeline and name == "corpus_pipeline.py") and (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    run = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, oracle = (set(line.split()) for line in run.stdout.splitlines())
    assert queries == oracle and "sales_trend" in queries and "pipeline" not in queries


def test_nothing_else_imports_the_operators():
    for path in [*(ROOT / "stratamart").rglob("*.py"), *(ROOT / "suite").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        if "llm" not in path.parts and path != Path(__file__):
            assert ".llm" not in path.read_text(), path
