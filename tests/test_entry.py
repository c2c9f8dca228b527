from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_works_without_the_llm_folders(tmp_path):
    shutil.copytree(ROOT / "sentrylake", tmp_path / "sentrylake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'report_severity' in q and not any(n.startswith('op') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, check=True)


def test_nothing_in_the_library_imports_the_llm_subpackage():
    for path in (ROOT / "sentrylake").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            text = path.read_text()
            assert "sentrylake.llm" not in text and "import llm" not in text and ".llm " not in text, path
