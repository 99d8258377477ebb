"""The driver's contract: entry, queries, SQL, and independence from the llm subpackage."""

import ast
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_names_and_sql():
    import __spark_entry__ as entry

    assert "page_span" in entry.queries()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_nothing_else_imports_the_llm_subpackage():
    for path in (ROOT / "diurna").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_imports_without_the_llm_subpackage(tmp_path):
    shutil.copytree(ROOT / "diurna", tmp_path / "diurna", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'page_span' in q and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_entry(spark):
    import __spark_entry__ as entry

    if Path("/root/testdata/sf0.001").is_dir():
        assert entry.entry(spark).limit(1).count() == 1
