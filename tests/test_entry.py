"""The entry point with and without its optional parts, and layouts that stay as they are."""

import copy
import os
import shutil
import subprocess
import sys

import pytest

from tapewright import schemas
from tapewright.schemas import BOOK_TOP
from tapewright.streaming import jobs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("kept", [(), ("corpus_pipeline.py",)], ids=["without both", "pipeline left over"])
def test_entry_without_the_optional_operators(tmp_path, kept):
    left_out = {"corpus_pipeline.py", "llm", "__pycache__", ".git"} - set(kept)
    shutil.copytree(ROOT, tmp_path / "repo", ignore=lambda folder, names: [n for n in names if n in left_out])
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q; print(sorted(set(e.oracle_sql()) - set(q)))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == "[]"


def test_tables_leave_the_shared_layouts_alone(tmp_path):
    layouts = {n: v for n, v in vars(schemas).items() if hasattr(v, "fieldNames")}
    before = {n: copy.deepcopy(v) for n, v in layouts.items()}
    for _ in range(2):
        assert jobs.book_table(str(tmp_path)).schema.fieldNames() == [*BOOK_TOP.fieldNames(), "shard"]
    assert layouts == before
