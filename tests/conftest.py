import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("wordform-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wordform-test-ckpt-"))
    from wordform.session import share_code

    share_code(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def affixes(spark):
    from wordform import PREFIX_FILE, SUFFIX_FILE
    from wordform.sources.lists import read_affixes

    return read_affixes(spark, PREFIX_FILE, SUFFIX_FILE)
