"""The command line lists every registered report."""

import os
import subprocess
import sys

from quarry.plans import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_lists_reports():
    out = subprocess.run([sys.executable, "-m", "quarry", "list"], capture_output=True, text=True,
                         cwd=ROOT, timeout=120, check=True).stdout
    names = {line.split()[0] for line in out.splitlines() if line.strip()}
    assert names == set(QUERIES)


def test_entry_loads_by_file_path():
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', %r); m = u.module_from_spec(s); "
            "s.loader.exec_module(m); print(set(m.oracle_sql()) <= set(m.queries()) and len(m.oracle_sql()) > 0)"
            % os.path.join(ROOT, "__spark_entry__.py"))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd="/",
                         timeout=120, check=True).stdout
    assert out.strip() == "True"
