import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW_SCHEMA = ("fullVisitorId string, visitId string, visitNumber string, date string, "
              "visitStartTime string, channelGrouping string, socialEngagementType string, "
              "device string, customDimensions string, geoNetwork string, trafficSource string, "
              "totals string, hits string")

RAW_ROW = {
    "fullVisitorId": "u1", "visitId": "1", "visitNumber": "1", "date": "20170101",
    "visitStartTime": "1483228800", "channelGrouping": "Direct",
    "socialEngagementType": "Not Socially Engaged", "device": '{"browser": "x"}',
    "customDimensions": "[]", "geoNetwork": "{}", "trafficSource": "{}",
    "totals": '{"visits": "1"}', "hits": "[{'type': 'PAGE', 'page': {'pagePath': '/a'}}]",
}


@pytest.fixture
def raw(spark):
    """Raw visits from partial rows; what a row leaves out takes a usual value."""
    def build(*rows):
        full = [tuple({**RAW_ROW, **row}.values()) for row in rows]
        return spark.createDataFrame(full, RAW_SCHEMA)
    return build
