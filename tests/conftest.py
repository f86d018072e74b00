import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from docquarry.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def out(tmp_path):
    """A path below the test's own folder."""
    return lambda name: str(tmp_path / name)


@pytest.fixture(scope="session")
def variant(spark):
    """DataFrame with one VARIANT column ``doc`` from JSON texts."""
    from pyspark.sql import functions as F

    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "text string").select(F.parse_json("text").alias("doc"))

    return make


@pytest.fixture(scope="session")
def plan_of(spark):
    """Physical plan text of a DataFrame."""
    return lambda df: df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
