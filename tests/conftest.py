from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from tillroll.session import ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # tests run on one machine: a scratch checkpoint folder, only where unset
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="tillroll-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="tillroll-test-")
