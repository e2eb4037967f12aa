"""The entry module with and without the optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from foulee.testbed import catalogue

ROOT = Path(__file__).resolve().parent.parent
OPTIONAL = ["foulee/llm", "tests/llm", "corpus_pipeline.py"]


def _names_in_a_copy(tmp_path, *left_out, extra=None):
    copy = tmp_path / "copy"
    gone = {str(ROOT / name) for name in left_out}
    shutil.copytree(
        ROOT, copy, ignore=lambda folder, names: [n for n in names if n.startswith(".") or n == "__pycache__" or str(Path(folder, n)) in gone]
    )
    if extra:
        (copy / OPTIONAL[0]).mkdir()
        (copy / OPTIONAL[0] / "__init__.py").write_text(extra)
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return [line.split() for line in done.stdout.splitlines()]


@pytest.mark.parametrize("left_out", [OPTIONAL, OPTIONAL[:2]])
def test_imports_without_the_optional_parts(tmp_path, left_out):
    names, twins = _names_in_a_copy(tmp_path, *left_out)
    assert names == list(catalogue.QUERIES) and set(twins) == set(names)


def test_an_error_inside_an_optional_part_is_not_hidden(tmp_path):
    with pytest.raises(AssertionError, match="broken on purpose"):
        _names_in_a_copy(tmp_path, "foulee/llm", extra="raise ImportError('broken on purpose')")
