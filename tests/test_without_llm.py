"""The entry works without the training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_them():
    for path in (ROOT / "paperloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "paperloom.llm" not in path.read_text()


def test_entry_without_them(tmp_path):
    for name in ("__spark_entry__.py", "paperloom"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else None
    package = tmp_path / "paperloom"
    package.mkdir()
    for part in (ROOT / "paperloom").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (package / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'benchmark_fields' in q and not any(x.startswith('op1_') for x in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, check=True, timeout=120)


def test_entry_without_their_libraries(tmp_path):
    """A library that only they need is missing: all other queries are there."""
    for name in ("xxhash", "zstandard", "regex", "tokenizers"):
        (tmp_path / f"{name}.py").write_text("raise ImportError('not here')")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'benchmark_fields' in q and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, env={"PYTHONPATH": f"{tmp_path}:{ROOT}", "PATH": "/usr/bin:/bin"}, check=True, timeout=120)
