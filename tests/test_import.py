"""The entry without the training-data operators, and with them."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as contract
from tests.conftest import ROOT

LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def listed(folder):
    done = subprocess.run(
        [sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=120, check=False
    )
    assert done.returncode == 0, done.stderr[-1000:]
    return [line.split() for line in done.stdout.splitlines()]


def copied(target, *left_out):
    ignore = shutil.ignore_patterns(".git", "__pycache__", *left_out)
    return shutil.copytree(ROOT, target, ignore=ignore)


def own(names):
    return sorted(n for n in names if n != "pipeline" and not (n.startswith("op") and n[2:3].isdigit()))


def test_the_rest_imports_without_the_training_data_operators(tmp_path):
    queries, oracles = listed(copied(tmp_path / "bare", "llm", "corpus_pipeline.py"))
    assert queries == own(contract.queries())
    assert oracles == own(contract.oracle_sql())


def test_an_empty_folder_left_behind_does_not_matter(tmp_path):
    bare = copied(tmp_path / "bare", "llm", "corpus_pipeline.py")
    os.makedirs(bare / "palimpsest" / "llm" / "__pycache__")
    assert listed(bare)[0] == own(contract.queries())


def test_a_pipeline_file_left_behind_does_not_matter(tmp_path):
    assert listed(copied(tmp_path / "bare", "llm"))[0] == own(contract.queries())


def test_a_missing_library_is_not_hidden(tmp_path):
    folder = copied(tmp_path / "broken")
    if not os.path.isdir(folder / "palimpsest" / "llm"):
        return
    (folder / "palimpsest" / "llm" / "queries.py").write_text("import no_such_library\n")
    done = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, timeout=120, check=False)
    assert done.returncode != 0
