from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from finspark.session import SESSION_CONF, apply_session_conf, ensure_checkpoint_dir

    scratch = tmp_path_factory.mktemp("spark")
    b = (SparkSession.builder.master("local[*]").appName("finspark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", str(scratch / "checkpoint"))
         .config("spark.sql.warehouse.dir", str(scratch / "warehouse")))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_session_conf(s)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
