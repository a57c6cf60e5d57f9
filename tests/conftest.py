import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import checkpoint_dir, get_spark  # noqa: E402

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = get_spark("local[4]", app="strata-tests", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g",
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-warehouse-")})
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf():
    return SF
