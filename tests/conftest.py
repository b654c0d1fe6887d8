import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from textrail.session import build_session
    ck = tempfile.mkdtemp(prefix="run-test-ck-")
    s = build_session("local[4]", 8, app_name="textrail-tests", checkpoint_dir=ck,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run():
    return tempfile.mkdtemp(prefix="run-test-")


def one_col(spark, values, name="x", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def col_values(df, name):
    return [r[name] for r in df.collect()]
