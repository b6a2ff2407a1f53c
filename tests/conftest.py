import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tierbook.session import build_session

    shared = f"file://{tmp_path_factory.mktemp('shared')}"
    session = build_session("local[4]", app_name="tierbook-tests", shuffle_partitions=4, extra={"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture()
def lake(spark):
    from tierbook.plans.registry import Lake

    return Lake(spark, "test")


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
