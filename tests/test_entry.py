"""The driver's contract."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as e

ROOT = Path(__file__).resolve().parents[1]


def test_entry_and_names(spark):
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_the_library_stands_without_the_subpackage(tmp_path):
    for part in ("corpusloom", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / part), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "corpusloom/llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'authority_counts' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_nothing_else_imports_the_subpackage():
    for file in (ROOT / "corpusloom").rglob("*.py"):
        if "llm" not in file.parts:
            assert "corpusloom.llm" not in file.read_text(), file
