import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shopflow.session import checkpoint_root, configure
    s = (SparkSession.builder.master("local[*]")
         .appName("shopflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         # tests only: no cluster names a shared checkpoint folder here
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shopflow-test-ckpt-"))
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="shopflow-test-")
