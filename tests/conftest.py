import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from stopflow.session import DEFAULT_CONF, shared_dir

    b = SparkSession.builder.master("local[4]").appName("stopflow-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # uses spark.checkpoint.dir when set, else a fresh temp folder
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stopflow-test-")


SF_SMALL = "/root/testdata/sf0.001"
