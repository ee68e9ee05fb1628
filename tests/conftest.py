import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strataframe.session import local_session

# The fixture files of the delivery format (public test inputs), as text.
MINI = """\
"GROUP","PROJ"
"HEADING","PROJ_ID","PROJ_NAME"
"UNIT","",""
"TYPE","ID","X"
"DATA","P1","Demo project"

"GROUP","LOCA"
"HEADING","LOCA_ID","LOCA_TYPE","LOCA_GL"
"UNIT","","","m"
"TYPE","ID","PA","2DP"
"DATA","BH01","CP","100.50"
"DATA","BH02","TP","98.00"

"GROUP","SAMP"
"HEADING","LOCA_ID","SAMP_TOP","SAMP_REF","SAMP_TYPE","SAMP_ID"
"UNIT","","m","","",""
"TYPE","ID","2DP","X","PA","ID"
"DATA","BH01","1.50","S1","U","SA1"
"DATA","BH01","3.00","S2","U","SA2"
"DATA","BH02","2.00","S3","D","SA3"
"""

REDECLARED = "\r\n".join([
    '"GROUP","LOCA"', '"HEADING","LOCA_ID"', '"UNIT",""', '"TYPE","ID"', '"DATA","BH01"', "",
    '"GROUP","PROJ"', '"HEADING","PROJ_ID"', '"UNIT",""', '"TYPE","ID"', '"DATA","P1"', "",
    '"GROUP","LOCA"', '"HEADING","LOCA_ID"', '"UNIT",""', '"TYPE","ID"', '"DATA","BH02"', "",
])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, app="tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_splits(spark):
    """Force many splits per file for the duration of a test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]

    def apply(size: int) -> None:
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield apply
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.fixture
def mini(tmp_path):
    path = tmp_path / "mini.ags"
    path.write_text(MINI)
    return str(path)


@pytest.fixture
def redeclared(tmp_path):
    path = tmp_path / "redeclared.ags"
    path.write_bytes(REDECLARED.encode())
    return str(path)
