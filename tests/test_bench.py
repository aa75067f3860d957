"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from conftest import SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=1200, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["metric"]
    assert rec["value"] == round(sum(rec["queries"].values()), 3) or \
        abs(rec["value"] - sum(rec["queries"].values())) < 0.01
    assert all(v > 0 for v in rec["queries"].values())
