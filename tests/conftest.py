from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pacegrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    extra = {
        "spark.sql.shuffle.partitions": "4",
        # No capture of call sites: it costs several calls into the JVM per column.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Many short plans: quick compilation matters more than peak speed.
        "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
    }
    session = local_session("8", "tests", extra)
    yield session
    session.stop()
