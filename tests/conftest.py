import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent.parent}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from postlake.session import session

    s = session("tests", "local[4]", spark_sql_shuffle_partitions="4", spark_ui_showConsoleProgress="false", spark_driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not Path(SF).is_dir():
        pytest.skip("no test tables")
    return SF
