"""The contract module stands without the subpackage of operators for training data."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
_SHOW = "import __spark_entry__ as c; print(len(c.queries()), len(c.oracle_sql()), 'pipeline' in c.queries())"


def copied(tmp_path, *gone):
    target = tmp_path / "copy"
    skip = shutil.ignore_patterns(".git", "__pycache__", "*.json")
    shutil.copytree(ROOT, target, ignore=lambda d, names: {
        *skip(d, names), *(n for n in names if str((Path(d) / n).relative_to(ROOT)) in gone)
    })
    return target


def shown(folder):
    done = subprocess.run([sys.executable, "-c", _SHOW], cwd=folder, capture_output=True, text=True)
    return done.returncode, done.stdout, done.stderr


@pytest.mark.parametrize("gone", [
    ("mailsift/llm", "tests/llm"), ("mailsift/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",),
])
def test_the_rest_imports_without_them(tmp_path, gone):
    code, out, err = shown(copied(tmp_path, *gone))
    assert code == 0, err
    n_queries, n_sql, pipeline = out.split()
    assert int(n_queries) >= 45 and int(n_sql) >= 45 and pipeline == "False"


def test_errors_within_are_not_hidden(tmp_path):
    folder = copied(tmp_path)
    (folder / "mailsift/llm/common.py").write_text("import no_such_module_of_ours")
    code, _, err = shown(folder)
    assert code != 0 and "no_such_module_of_ours" in err
