"""The suite is collected as one run, from the root."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_whole_suite_is_collected():
    run = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
                         cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stdout[-2000:]
    here = os.path.join(ROOT, "tests")
    for folder, _, files in os.walk(here):
        for name in files:
            if name.startswith("test_") and name.endswith(".py"):
                assert os.path.relpath(os.path.join(folder, name), ROOT) in run.stdout
