import importlib
import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 80


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"source", "records", "tokens"}


def test_core_stands_without_the_subpackage(tmp_path):
    code = "import sys; sys.modules['boreal.llm'] = None; import __spark_entry__ as e; assert not any(q[:1] == 'p' and q[1:2].isdigit() for q in e.queries()); print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr


def test_nothing_in_the_core_imports_it():
    for path in (ROOT / "boreal").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "boreal").parts:
            assert "boreal.llm" not in path.read_text(encoding="utf-8")
    assert importlib.util.find_spec("boreal") is not None
