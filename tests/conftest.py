from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from mailsift import session
from tests.trees import write_tree


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A local session. Its checkpoint folder is the session's own if it names one."""
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("mailsift-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.default.parallelism", "8")
    )
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
    spark.sparkContext.setLogLevel("ERROR")
    return session.tune(spark)


@pytest.fixture(scope="session")
def bucket(tmp_path_factory):
    """The edge case tree, written once; tests that change it make their own."""
    root = tmp_path_factory.mktemp("bucket")
    write_tree(root)
    return str(root)


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")
