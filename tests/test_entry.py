import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["kraj", "okres", "doc_kategoria", "datum", "nazov", "url", "doc_id"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_optional_part(tmp_path):
    """The entry imports and runs where the optional subpackage is absent."""
    import shutil

    shutil.copytree(ROOT / "noticelake", tmp_path / "noticelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not any(k[:2] == 'op' and k[2].isdigit() or k == 'pipeline' for k in q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr


def test_nothing_else_imports_it():
    for p in (ROOT / "noticelake").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "noticelake.llm" not in p.read_text()
