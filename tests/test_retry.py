"""Task failures are retried without duplicate or missing records."""
import os
import subprocess
import sys


def test_failed_first_attempts_are_retried(tmp_out):
    script = os.path.join(os.path.dirname(__file__), "retry_job.py")
    out = os.path.join(tmp_out, "sorted")
    r = subprocess.run([sys.executable, script, out], capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stdout[-2000:] + r.stderr[-4000:]
    assert "RESULT True" in r.stdout
