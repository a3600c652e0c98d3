import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from tests.conftest import SF001, have_testdata

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data missing")


def test_bench_prints_one_json_line():
    repo = Path(__file__).resolve().parents[1]
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, str(repo / "bench.py"), "page_views"], cwd=repo,
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001 and "page_views" in d["queries"]
