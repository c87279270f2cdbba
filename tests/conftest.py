import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from contrail.session import get_spark, shared_dir
    s = get_spark("local[4]", app="contrail-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="contrail-wh-"),
    })
    shared_dir(s)  # tests run local: a temp folder is used only when none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="contrail-test-")
