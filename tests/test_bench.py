"""bench.py prints exactly one JSON line with the agreed keys."""
import json
import os
import subprocess
import sys


def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4",
               BENCH_QUERIES="checksum_total,size_functions")
    r = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    lines = [ln for ln in r.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_sec" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"checksum_total", "size_functions"}
    assert d["value"] > 0
