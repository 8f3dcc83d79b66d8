"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and rec["value"] > 0
    assert "final_assemble" in rec["queries"] and all(v >= 0 for v in rec["queries"].values())
