import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from aerowx.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = local_session(cpus=8, partitions=4, memory="4g", settings=warehouse)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """A DataFrame's rows as sorted tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture
def plan_of():
    """A DataFrame's physical plan, with all scan details."""

    def explain(df):
        utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
        return utils.explainString(df._jdf.queryExecution(), "formatted")

    return explain
