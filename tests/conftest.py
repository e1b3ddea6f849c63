import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slicehouse.session import drop_scratch, get_session  # noqa: E402

TESTDATA = os.environ.get("SLICEHOUSE_TESTDATA", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="slicehouse-test-")
    session = get_session(
        "slicehouse tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TESTDATA
