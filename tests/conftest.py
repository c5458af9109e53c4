import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stationlake import schemas  # noqa: E402
from stationlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A sound raw row; tests override what they are about.
SOUND = {
    "station_id": "1",
    "num_bikes_available": "5",
    "num_ebikes_available": "1",
    "num_bikes_disabled": "0",
    "num_docks_available": "10",
    "num_docks_disabled": "0",
    "is_installed": "1",
    "is_renting": "1",
    "is_returning": "1",
    "station_status_last_reported": "1700000000",
    "station_name": "Main St",
    "lat": "40.5",
    "lon": "-74.25",
    "region_id": "7",
    "capacity": "20",
    "has_kiosk": "true",
    "station_information_last_updated": "1700000000",
    "missing_station_information": "false",
}


@pytest.fixture(scope="session")
def raw(spark):
    """raw({...}, {...}): raw rows in the given arrival order, one file."""

    def build(*rows, source="a.csv"):
        data = [
            tuple({**SOUND, **row}[c] for c in schemas.RAW_COLUMNS) + (source, source, i)
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(data, schemas.RAW_LAYER)

    return build


@pytest.fixture
def write_csv():
    """Write feed text files; values go in as they are."""

    def write(folder, name, *rows, header=None):
        folder.mkdir(exist_ok=True)
        lines = [",".join(header or schemas.RAW_COLUMNS)]
        lines += [",".join({**SOUND, **row}[c] for c in schemas.RAW_COLUMNS) for row in rows]
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(folder)

    return write


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
