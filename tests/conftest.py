import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("terrace-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="terrace-tests-"))
         .config("spark.sql.maxMetadataStringLength", "1000")  # plans name whole paths
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_job_group(request):
    """A job group that one test sets would hide the jobs of later ones."""
    yield
    if "spark" in request.fixturenames:
        context = request.getfixturevalue("spark").sparkContext
        for name in ("spark.jobGroup.id", "spark.job.description"):
            context.setLocalProperty(name, None)
