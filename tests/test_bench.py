import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g",
               BENCH_QUERIES="adhoc_best_listing_type,mart_host_neighbourhood",
               BENCH_WARMUP_DIR="/nonexistent")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == "0.001"
    assert set(out["queries"]) == {"stage_raw_snapshot", "adhoc_best_listing_type",
                                   "mart_host_neighbourhood"}
    assert out["value"] == pytest.approx(sum(out["queries"].values()), abs=0.01)
