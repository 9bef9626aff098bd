"""Names of tables and adapters in SQL texts."""

import os
import subprocess
import sys

from workload.adapters import oracle


def test_shifts_of_bits_are_no_names():
    assert oracle("SELECT 1 << 3 AS x, r_name FROM <<region>> AS r") == "SELECT 1 << 3 AS x, r_name FROM region AS r"


def test_the_queries_can_be_read():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run(["timeout", "60", sys.executable, "-B", "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=root, capture_output=True, text=True)
    assert said.returncode == 0 and int(said.stdout) > 70, said.stderr
