import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))
# Functions of test modules are pickled by name, so the Python workers must find them too.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])

from shapeloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test: ``settings({"key": "value"})``."""
    saved = {}

    def change(values):
        for key, value in values.items():
            saved.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in saved.items():
        spark.conf.set(key, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return plan_of
