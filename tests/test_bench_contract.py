"""bench.py prints exactly one JSON line with the driver's fields (run from another directory)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(scratch):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "prompt_performance", "batch_inference"],
                         cwd=scratch, env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"prompt_performance", "batch_inference"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
