import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from turnout.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture()
def session_zone(spark):
    """Run a block under several session time zones, restoring the original."""
    old = spark.conf.get("spark.sql.session.timeZone")

    def use(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)

    yield use
    spark.conf.set("spark.sql.session.timeZone", old)
