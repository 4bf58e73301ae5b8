"""The library without the text operators."""

import os
import re
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_text_operators(tmp_path):
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    shutil.copytree(
        f"{REPO}/cardledger", tmp_path / "cardledger", ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")]
    )
    code = "import __spark_entry__ as e; print('names', *e.queries()); print('checks', len(e.oracle_sql()))"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert "post_daily" in done.stdout, done.stderr
    assert not re.search(r" op\d+_", done.stdout) and "pipeline" not in done.stdout
