import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from layerkit.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="layerkit-tests-")
    s = local_session(
        "*",
        8,
        **{
            "spark.sql.warehouse.dir": f"{base}/warehouse",
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}/derby",
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
