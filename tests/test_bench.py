"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "climatology", "histogram"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    doc = json.loads(lines[0])
    assert doc["metric"] == "total_sec" and doc["unit"] == "sec" and doc["sf"] == 0.001
    assert set(doc["queries"]) == {"climatology", "histogram"}
    assert abs(doc["value"] - sum(doc["queries"].values())) < 1e-6
