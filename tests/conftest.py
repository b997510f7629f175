import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staylink.session import LOCAL_CONF  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]").appName("staylink-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="staylink-test-ckpt-")))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s
    s.stop()
