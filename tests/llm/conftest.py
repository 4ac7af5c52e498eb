import pytest
from pyspark import cloudpickle

import casewise

cloudpickle.register_pickle_by_value(casewise)


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """A folder that all tasks of the test session reach."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
