import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from climcube.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = local_session(
        cores=4,
        memory="4g",
        **{
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.sql.maxMetadataStringLength": "4000",
            "spark.ui.showConsoleProgress": "false",
            "spark.local.dir": str(scratch / "local"),
        },
    )
    yield session
    session.stop()
