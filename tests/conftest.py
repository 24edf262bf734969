import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import SparkSession

from wattlake import vocabulary as V
from wattlake.session import use_utc

UTC = dt.timezone.utc
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield use_utc(session)


@pytest.fixture
def folder(tmp_path):
    return lambda name="t": f"{tmp_path}/{name}-{uuid.uuid4().hex[:8]}"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


@pytest.fixture(scope="session")
def make_events(spark):
    """Records from texts or dictionaries; offset is the position."""

    def make(messages, topic=V.TOPIC_MIX, start="2024-01-06T10:00:00", first=0):
        rows = []
        for i, message in enumerate(messages, first):
            text = json.dumps(message) if isinstance(message, dict) else message
            value = None if text is None else bytearray(text.encode())
            rows.append((None, value, topic, 0, i, at(start) + dt.timedelta(seconds=i), 0))
        return spark.createDataFrame(rows, V.EVENT)

    return make


def mix(zone="FR", time="2024-01-06T09:00:00.000Z", total=100.0, used=90.0, **more):
    return {"zone": zone, "datetime": time, "powerProductionTotal": total,
            "powerConsumptionTotal": used, **more}


def carbon(zone="FR", time="2024-01-06T09:00:00.000Z", intensity=50.0, **more):
    return {"zone": zone, "datetime": time, "carbonIntensity": intensity, **more}
