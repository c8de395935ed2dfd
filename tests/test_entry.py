"""The registry, and the library without its llm subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).parent.parent


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and {"p1_found", "p2_found"} <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["lib", "complex", "chr", "kind", "start_pos", "end_pos"]


def test_imports_without_llm(tmp_path):
    for name in ("strandloom", "__spark_entry__.py"):
        source = REPO / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and not [x for x in q if x[:2] in ('p3', 'p4', 'p5', 'p6', 'p7', 'p8')]; print(len(q))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout) > 90, done.stderr


def test_nothing_else_imports_llm():
    for path in (REPO / "strandloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "strandloom.llm" not in path.read_text()
