"""The training-data operators give the same results when tasks fail and are retried."""

import os
import subprocess
import sys

from conftest import SF001

HERE = os.path.dirname(os.path.abspath(__file__))


def test_results_survive_task_retries():
    out = subprocess.run([sys.executable, os.path.join(HERE, "retry_operators.py"), SF001], capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().endswith("OK"), out.stdout[-2000:]
