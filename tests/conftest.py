import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourlake.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "hourlake-tests", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "8",
    })
    yield session
    session.stop()


@pytest.fixture
def workdir():
    # A fresh folder per test; never cleaned by the tests themselves.
    return tempfile.mkdtemp(prefix="run-hourlake-test-", dir="/tmp")


def write_plain(root, hour, name, lines):
    """Land ``lines`` as one file of the plain layout root/YYYY/MM/DD/HH/name."""
    y, m, d, h = hour[:4], hour[5:7], hour[8:10], hour[11:13]
    folder = os.path.join(root, y, m, d, h)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as handle:
        handle.write("\n".join(lines) + ("\n" if lines else ""))
    return folder


def plan_text(df, mode="formatted"):
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
