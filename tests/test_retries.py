"""Results stay whole when tasks die half-way and are run again."""

import os
import subprocess
import sys


def test_results_survive_dying_tasks(folder):
    here = os.path.dirname(os.path.abspath(__file__))
    run = subprocess.run(
        [sys.executable, os.path.join(here, "retry_job.py"), folder],
        env={**os.environ, "PYTHONPATH": os.path.dirname(here)},
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert run.stdout.strip().endswith("all whole"), run.stdout[-2000:] + run.stderr[-4000:]
