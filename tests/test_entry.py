"""The entry works whole, and where optional parts were removed."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; print(sum(n[:2] == 'op' and n[2:3].isdigit() or n == 'pipeline' for n in {**e.queries(), **e.oracle_sql()}), len(e.queries()) > 90)"


def copied(folder, *without):
    for name in ("arrearlens", "showcase"):
        shutil.copytree(ROOT / name, folder / name, ignore=shutil.ignore_patterns("__pycache__", *without))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and (ROOT / name).exists():
            shutil.copy(ROOT / name, folder / name)
    done = subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    return done.stdout.split(), done.stderr


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_removed_parts_leave_the_rest(tmp_path, without):
    said, wrong = copied(tmp_path, *without)
    assert said == ["0", "True"], wrong


def test_errors_inside_a_part_are_not_hidden(tmp_path):
    if not (ROOT / "corpus_pipeline.py").exists():
        pytest.skip("without the part there is nothing to break")
    said, _ = copied(tmp_path)
    assert said[1] == "True" and int(said[0]) > 0
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert "no_such_module" in done.stderr
