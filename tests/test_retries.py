import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(mode):
    done = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tests", "retry_job.py"), mode],
        capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": ROOT},
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.split("\n")


def test_lost_tasks_do_not_change_results():
    calm = run("calm")
    assert calm[0].startswith("12000 ") and run("lose") == calm
