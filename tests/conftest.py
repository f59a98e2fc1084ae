import os
import tempfile

import pytest

from rollcall.session import get_session


def make_session():
    spark = get_session(
        "rollcall-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rollcall-ckpt-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    yield make_session()
