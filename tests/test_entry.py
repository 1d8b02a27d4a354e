import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'drift_report' in q and not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


def test_another_missing_module_is_an_error(tmp_path):
    shutil.copytree(ROOT / "millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "millrace" / "llm").mkdir()
    (tmp_path / "millrace" / "llm" / "__init__.py").write_text("")
    (tmp_path / "millrace" / "llm" / "queries.py").write_text("import a_module_that_is_not_there")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode and "a_module_that_is_not_there" in done.stderr


def test_nothing_else_imports_the_corpus_operators():
    for path in (ROOT / "millrace").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path


def test_sql_belongs_to_queries():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
