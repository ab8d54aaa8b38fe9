"""bench.py prints exactly one JSON line with the driver's keys."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "stg_laps", "final_race_leaderboard"],
        env=env, cwd=ROOT, capture_output=True, text=True, timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"stg_laps", "final_race_leaderboard"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
    assert result["errors"] == {}
