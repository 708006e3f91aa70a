import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillstream.session import local_session

    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session


@pytest.fixture
def scratch(spark):
    from tillstream.session import scratch_dir

    return lambda name: scratch_dir(spark, name)


@pytest.fixture(params=["UTC", "Asia/Tokyo", "America/New_York"])
def zone(request, spark):
    from tillstream.session import settings

    with settings(spark, {"spark.sql.session.timeZone": request.param}):
        yield request.param
