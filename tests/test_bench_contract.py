import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_CPUS="2", BENCH_QUERIES="player_stats,set_diff")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert doc["unit"] == "sec" and doc["sf"] == 0.001
    assert set(doc["queries"]) == {"player_stats", "set_diff"}
    assert doc["value"] == pytest.approx(sum(doc["queries"].values()), abs=0.01)
