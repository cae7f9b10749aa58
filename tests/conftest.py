import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curfew import schema  # noqa: E402
from curfew.operators import standardize  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


SESSION = {
    "player_id": "P1", "account_type": "minor", "game_id": "GAME_001", "login_time": "2024-01-10 12:00:00",
    "logout_time": "2024-01-10 13:00:00", "online_duration": 3600, "match_count": 3, "recharge_amount": "0",
    "item_consumption": 1, "login_ip": "192.168.1.5", "login_period": "白天", "game_region": "华东一区",
    "device_type": "ios",
}


def line(**changes) -> dict:
    """One raw row as text, with changes."""
    values = {**SESSION, **changes}
    return {name: None if values[name] is None else str(values[name]) for name in schema.RAW_FIELDS}


@pytest.fixture
def raw_of(spark):
    """Raw rows from dictionaries of changes."""
    def build(*changes):
        return spark.createDataFrame([tuple(line(**c).values()) for c in changes], schema.RAW)

    return build


@pytest.fixture
def facts_of(raw_of):
    """Facts from dictionaries of changes, neither cleaned nor folded."""
    def build(*changes):
        return standardize.to_facts(raw_of(*changes))

    return build


def rows(df):
    return [tuple(row) for row in df.collect()]


def values(df, column):
    return [row[column] for row in df.collect()]


DAY = date(2024, 1, 10)
NOW = datetime(2024, 1, 10, 12, 20)
