import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cinderpost.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", sql_shuffle_partitions=4, driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def posts(spark):
    """Small labelled posts with missing keywords, locations, links and empty texts."""
    rows = [
        (1, "fire", "LA", "Forest fire near http://t.co/a now", 1, "train"),
        (2, "fire", None, "Huge fire, people flee the fire", 1, "train"),
        (3, None, "NY", "I love this song &amp; the movie", 0, "train"),
        (4, "flood", None, "Flood waters can't stop http://t.co/b http://t.co/c", 1, "train"),
        (5, None, None, "what a lovely sunny day #sun", 0, "train"),
        (6, "fire", "LA", "my mixtape is fire", 0, "train"),
        (7, "flood", "UK", "flood of tears", 0, "test"),
        (8, "quake", None, "earthquake and fire reported", 1, "test"),
        (9, None, None, "", 0, "test"),
        (10, None, "NY", None, 1, "test"),
    ]
    schema = "id long, keyword string, location string, text string, target int, split string"
    return spark.createDataFrame(rows, schema)
