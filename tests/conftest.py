import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyledger.session import build_session  # noqa: E402
from skyledger.sources import decode_flights  # noqa: E402

# One line per rule of the data model; the last is no flight.
EDGE_LINES = """\
2008,4,2008-04-03,AA,1,BOS,ATL,0900,5,10
2008,4,2008-04-03,DL,2,BOS,ATL,0930,1,2
2008,4,2008-04-03,AA,3,BOS,ATL,1000,1,2
2008,4,2008-04-03,UA,4,BOS,ATL,1200,0,-30
2008,4,2008-04-03,UA,5,BOS,JFK,0700,,-8
2008,4,2008-04-03,ZZ,6,BOS,JFK,0800,3
2008,6,2008-04-05,DL,7,ATL,LAX,1300,2,-3
2008,6,2008-04-05,AA,8,ATL,LAX,1400,4,1
2008,6,2008-04-05,DL,9,ATL,LAX,1100,4,-20
2008,6,2008-04-05,DL,10,ATL,BOS,1500,0,0
2008,6,2008-04-05,DL,11,JFK,LAX,1500,0,4
2008,7,2008-04-06,DL,12,ATL,ORD,1500,0,-5
2007,4,2007-04-03,DL,13,BOS,ATL,0900,0,-40
2008,7,2008-03-08,AA,14,PHX,STL,0900,0,1
2008,1,2008-03-10,AA,15,STL,SNA,1500,0,2
this line is malformed
""".splitlines()


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "skyledger-tests", "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__log__level="ERROR",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edge_flights(spark):
    return decode_flights(spark.createDataFrame([(line,) for line in EDGE_LINES], "value STRING"))


@pytest.fixture
def folder(tmp_path):
    """A path under the test's own folder that does not exist yet."""
    return lambda: str(tmp_path / uuid.uuid4().hex)


@pytest.fixture
def line_files(folder):
    """Writes lines to several message files and returns their folder."""

    def write(lines, files=1, path=None):
        path = path or folder()
        os.makedirs(path, exist_ok=True)
        for i in range(files):
            with open(os.path.join(path, f"{uuid.uuid4().hex}.txt"), "w") as out:
                out.writelines(f"{line}\n" for line in lines[i::files])
        return path

    return write


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
