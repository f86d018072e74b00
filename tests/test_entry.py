"""The driver's entry without the optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; q = e.queries(); print(sum(n[:2] != 'op' for n in q), 'pipeline' in q, any(n[:2] == 'op' for n in q))"


def copied(tmp_path, *left_out):
    target = tmp_path / "repo"
    skip = shutil.ignore_patterns("__pycache__", ".git", "tests", *left_out)
    shutil.copytree(REPO, target, ignore=skip)
    return target


def ask(folder, *more):
    found = subprocess.run(
        [sys.executable, "-B", "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=300,
        env={**os.environ, "PYTHONPATH": os.pathsep.join([*map(str, more), str(folder)])},
    )
    assert found.returncode == 0, found.stderr
    return found.stdout.split()


@pytest.fixture(scope="module")
def core():
    from docquarry.checks.queries import registered

    return str(len(registered()))


def test_without_the_folder(tmp_path, core):
    assert ask(copied(tmp_path, "llm", "corpus_pipeline.py")) == [core, "False", "False"]
    assert ask(copied(tmp_path / "b", "llm")) == [core, "False", "False"]


def test_with_an_empty_folder(tmp_path, core):
    folder = copied(tmp_path, "llm")
    (folder / "docquarry/llm/__pycache__").mkdir(parents=True)
    assert ask(folder) == [core, "False", "False"]


def test_without_the_vocabulary_package(tmp_path, core):
    (tmp_path / "public_tokenizers.py").write_text("raise ModuleNotFoundError(\"No module named 'public_tokenizers'\", name='public_tokenizers')\n")
    assert ask(copied(tmp_path), tmp_path)[0] in (core, str(int(core) + 1))
