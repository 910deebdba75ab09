"""Without the training-text subpackage the entry module imports and lists the other queries."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import __spark_entry__ as e
names = e.queries()
assert "scanning" in names and not any(n == "pipeline" or n.startswith("op") and n[2].isdigit() for n in names)
assert set(e.oracle_sql()) <= set(names)
"""


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(os.path.join(REPO, "lansight"), tmp_path / "lansight",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_an_error_inside_the_subpackage_is_raised(tmp_path):
    shutil.copytree(os.path.join(REPO, "lansight"), tmp_path / "lansight",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    os.makedirs(tmp_path / "lansight" / "llm")
    (tmp_path / "lansight" / "llm" / "__init__.py").write_text("")
    (tmp_path / "lansight" / "llm" / "queries.py").write_text("import no_such_module_anywhere\n")
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True,
                          timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode != 0 and "no_such_module_anywhere" in done.stderr
