import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TALLY_TEST_SF", "/root/testdata/sf0.01")
SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyframe.session import build_session
    scratch = tempfile.mkdtemp(prefix="tally-tests-")
    session = build_session("local[*]", "tallyframe-tests", 4,
                            {"spark.checkpoint.dir": f"{scratch}/checkpoints",
                             "spark.sql.warehouse.dir": f"{scratch}/warehouse",
                             # no client-side .crc files (as on object stores): tests edit files in place
                             "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem"})
    session.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from tallyframe.session import work_dir
    path = work_dir(spark, "test")
    os.makedirs(path.removeprefix("file:"), exist_ok=True)  # tests also write there without Spark
    return path
