import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("COVISTA_DRIVER_MEMORY", "4g")
    from covista.session import local_session

    s = local_session(4, "tests", spark__sql__shuffle__partitions="4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    """The smallest of the driver's test tables."""
    d = "/root/testdata/sf0.001"
    if not Path(d).exists():
        pytest.skip("no test tables here")
    return d


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    db = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        db.execute(f"create view \"{f.stem}\" as select * from '{f}'")
    return db


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
