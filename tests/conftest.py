import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from hearthline.schemas import BRONZE  # noqa: E402
from hearthline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=4,
        spark__sql__warehouse__dir=tmp_path_factory.mktemp("warehouse"),
        spark__checkpoint__dir=tmp_path_factory.mktemp("checkpoint"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Bronze rows from (DeviceId, TimestampUTC, DeviceType, Status, Attributes) tuples, in arrival order."""

    def make(*rows, ingested_at="2024-01-01T00:00:00Z"):
        full = []
        for pos, (device, ts, kind, status, *rest) in enumerate(rows):
            attributes = rest[0] if rest else "{}"
            if not (attributes is None or isinstance(attributes, str)):
                attributes = json.dumps(attributes)
            full.append((device, ts, kind, status, attributes, ingested_at, "test", pos))
        return spark.createDataFrame(full, BRONZE)

    return make


SAMPLE = [
    ("wash-a", "2024-03-05T06:15:10", "Washing machine", "Program Start",
     {"Temperature": 45, "Temperature_Unit": "Celsius", "SpinningSpeed": 750, "TwinDos": [80, 64]}),
    ("wash-a", "2024-03-05T08:02:55", "Washing machine", "Program End",
     {"Temperature": 45, "Temperature_Unit": "Celsius", "SpinningSpeed": 750, "TwinDos": [80, 60]}),
    ("wash-b", "2024-03-06T10:30:00", "Washing machine", "Program Start",
     {"Temperature": 122, "Temperature_Unit": "Fahrenheit", "SpinningSpeed": 1250}),
    ("wash-b", "2024-03-06T10:41:07", "Washing machine", "Program Failure", {"FailureIds": [3, 8, 21]}),
    ("wash-c", "2024-03-07T19:00:01", "Washing machine", "Program Failure", {"FailureIds": [8]}),
    ("brew-a", "2024-03-07T12:00:30", "Coffee Machine", "Program End",
     [{"Id": "Strength", "Value": 70, "Unit": "Percentage"}, {"Id": "Heat", "Value": 91, "Unit": "Celsius"}]),
    ("brew-b", "2024-03-07T12:00:30", "Coffee Machine", "Program End", [{"Id": "Heat", "Value": 91, "Unit": "Celsius"}]),
    ("dish-a", "2024-03-08T20:20:20", "Dishwasher", "Program End",
     {"Temperature": 131, "Temperature_Unit": "Fahrenheit", "QuickPowerWashActive": 1}),
]


def as_messages(rows):
    names = ["DeviceId", "TimestampUTC", "DeviceType", "Status", "Attributes"]
    return [dict(zip(names, row)) for row in rows]


@pytest.fixture
def sample():
    return list(SAMPLE)
