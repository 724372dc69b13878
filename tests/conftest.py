import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlab.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", **{"spark.sql.shuffle.partitions": "4",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="churnlab-test-ckpt-")})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="churnlab-test-")
