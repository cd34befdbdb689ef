"""bench.py prints one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from datapaths import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert "failed" not in result
    assert set(result["queries"]) >= {"item_topk", "candidates", "recommend"}
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-6 + 0.01
