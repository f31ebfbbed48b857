"""The entry imports with and without the optional operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
_COUNT = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n == 'pipeline' or n[:2] == 'op' and n[2:3].isdigit()))"


def copied(to: Path, *left_out: str) -> Path:
    for name in ("tallyrill", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / name
        if not source.exists() or name in left_out:
            continue
        if source.is_dir():
            shutil.copytree(source, to / name, ignore=shutil.ignore_patterns("__pycache__", *left_out))
        else:
            shutil.copy(source, to / name)
    return to


def optional_queries(folder: Path, *before: str) -> str:
    run = subprocess.run([sys.executable, "-c", "; ".join((*before, _COUNT))], cwd=folder, capture_output=True, text=True,
                         timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.strip()


@pytest.mark.parametrize("left_out", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_without_the_optional_folder(tmp_path, left_out):
    assert optional_queries(copied(tmp_path, *left_out)) == "[]"


def test_entry_without_an_optional_package(tmp_path):
    """A package only the optional operators need costs those alone."""
    blocked = "import sys; sys.modules['zstandard'] = None"
    assert optional_queries(copied(tmp_path), blocked) == "[]"
