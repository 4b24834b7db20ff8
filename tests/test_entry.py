"""The entry module with and without the optional training-data operators, in copies of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def registered(folder):
    done = subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return [set(line.split()) for line in done.stdout.splitlines()]


@pytest.mark.parametrize("without", [["quarry/llm"], ["quarry/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_optional_parts_may_be_missing(tmp_path, without):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path / name)
    shutil.copytree(REPO / "quarry", tmp_path / "quarry", ignore=shutil.ignore_patterns("__pycache__"))
    for name in without:
        path = tmp_path / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    queries, oracles = registered(tmp_path)
    assert "pipeline" not in queries and len(queries) > 150 and oracles <= queries
    llm = (tmp_path / "quarry/llm").is_dir()
    assert any(q.startswith("op1_") for q in queries) == llm


def test_a_broken_part_is_not_passed_over(tmp_path):
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "quarry", tmp_path / "quarry", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    (tmp_path / "quarry/llm").mkdir()
    (tmp_path / "quarry/llm/__init__.py").write_text("")
    (tmp_path / "quarry/llm/queries.py").write_text("import a_module_that_nobody_has")
    done = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "a_module_that_nobody_has" in done.stderr


def test_another_copy_on_the_path_is_not_taken(tmp_path, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", str(REPO))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "quarry", tmp_path / "quarry", ignore=shutil.ignore_patterns("__pycache__"))
    assert "pipeline" not in registered(tmp_path)[0]
