import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="simsift-test-")
    s = (SparkSession.builder.master("local[*]").appName("simsift-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests only: the checkpoint folder is unset locally, so use a private one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    s.conf.set("simsift.test.scratch", scratch)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, tmp_path):
    return str(tmp_path)
