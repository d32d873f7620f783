"""Every test module is collected, also beside the tests of ``kiln.llm``."""

from __future__ import annotations

import os
import subprocess
import sys


def test_all_modules_are_collected():
    here = os.path.dirname(os.path.abspath(__file__))
    done = subprocess.run([sys.executable, "-m", "pytest", here, "--collect-only", "-q", "-p", "no:cacheprovider"],
                          capture_output=True, text=True, cwd=os.path.dirname(here))
    assert done.returncode == 0, done.stdout[-2000:]
    assert "test_oracle.py" in done.stdout and "test_plans.py" in done.stdout
