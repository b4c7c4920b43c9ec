import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from convometrics.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("local[8]", "convometrics-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
