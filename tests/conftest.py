import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sensor(spark):
    """Make a sensor stream from (road, tick, speed[, count]) tuples."""

    def make(*rows):
        data = [
            (f"p{i:04d}", "I101", r[0], "S1", r[3] if len(r) > 3 else 1, r[2], 1.0, r[1])
            for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(
            data,
            "pkt_id string, intersection_id string, road_id string, signal_id string, "
            "vehicle_count int, avg_speed double, occupancy double, ts int",
        )

    return make


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
