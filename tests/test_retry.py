import json
import os
import subprocess
import sys

import pytest

from conftest import write_plain

SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "retry_ingest.py")


@pytest.mark.parametrize("strategy", ["direct", "rebalance"])
def test_ingest_survives_a_lost_task(workdir, strategy):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    for h in range(6):
        write_plain(src, f"2024-01-01 0{h}", "p.json", [f'{{"id":{h * 10 + i}}}' for i in range(10)])
    out = subprocess.run([sys.executable, SCRIPT, src, dest, strategy], capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["documents"] == result["published"] == 60
    assert result["ids"] == list(range(60))
