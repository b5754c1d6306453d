import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from farelens.session import build_session  # noqa: E402
from farelens.sources.rides import RIDE_SCHEMA  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[8]", shuffle_partitions=8)
    yield s


NAN = float("nan")
BASE = dict(fare=6.0, plon=-73.98, plat=40.75, dlon=-73.95, dlat=40.78,
            ts=dt.datetime(2012, 6, 13, 12, 0, 0), pax=1)

# FIXTURES.md section 3: only differences from the default row are listed.
EDGE = {
    "e00": {},
    "e01": dict(fare=2.5),
    "e02": dict(fare=2.49),
    "e03": dict(fare=None),
    "e04": dict(fare=NAN),
    "e05": dict(fare=5.0),
    "e06": dict(fare=10.0),
    "e07": dict(fare=7.5),
    "e08": dict(fare=-3.0),
    "e09": dict(plon=-74.01, plat=40.65),
    "e10": dict(plon=-73.932, plat=40.80),
    "e11": dict(plon=-73.98, plat=40.70),
    "e12": dict(plon=0.0),
    "e13": dict(pax=0),
    "e14": dict(plon=None),
    "e15": dict(plon=NAN),
    "e16": dict(plon=40.75, plat=-73.98, dlon=40.78, dlat=-73.95),
    "e17": dict(ts=dt.datetime(2010, 1, 31, 23, 30, 0)),
    "e18": dict(ts=dt.datetime(2010, 3, 1, 7, 0, 0)),
    "e19": dict(ts=dt.datetime(2010, 2, 28, 22, 59, 59)),
    "e20": dict(ts=dt.datetime(2011, 12, 5, 16, 0, 0)),
    "e21": dict(ts=dt.datetime(2011, 12, 5, 20, 59, 59)),
    "e22": dict(plon=-74.5, plat=40.5, dlon=-72.8, dlat=41.8),
    "e23": dict(dlon=-73.98, dlat=40.75),
    "e24": dict(plon=0.5, plat=0.5, dlon=-179.5, dlat=-0.5),
}


def edge_rows():
    rows = []
    for key, diff in EDGE.items():
        r = {**BASE, **diff}
        rows.append((key, r["fare"], r["ts"], r["plon"], r["plat"], r["dlon"], r["dlat"], r["pax"]))
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), RIDE_SCHEMA)


def keys(df):
    return sorted(r["key"] for r in df.select("key").collect())
