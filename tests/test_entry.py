"""The entry module must import wherever PySpark does, with or without its jars."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_import_needs_no_jar(tmp_path):
    code = (
        f"import pyspark; pyspark.__file__ = {str(tmp_path / '__init__.py')!r}\n"
        "import __spark_entry__ as e\n"
        "assert set(e.oracle_sql()) <= set(e.queries()) and len(e.oracle_sql()) >= 65\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
