from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qoeflow import schema  # noqa: E402
from qoeflow.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="qoeflow-tests")
    yield s


def playback(**kw) -> dict:
    """A raw playback-end row that passes every eligibility rule unless overridden."""
    row = dict(
        accountSourceId="acc1", deviceSourceId="AA:BB:CC:DD:EE:01", pluginSessionId="s1", playbackId="p1",
        eventtype="End", applicationname="STB-XI6", assetclass="Linear", completionstatus="Success",
        starttime=1000000, sessionduration=600000, bitrate=[850000, 3718000, 850000],
        clientGeneratedTimestamp=[1002000, 1012000, 1300000],
        playstateChanged=[{"value": "initializing"}, {"value": "playing"}],
        mediaOpenLatency=1, bufferunderflow=0, buffercount=1, bufferratio=0.5, title="lin:7",
        received_date=dt.date(2021, 9, 15), az_insert_ts=dt.datetime(2021, 9, 15, 17, 0, 0),
    )
    row.update(kw)
    return row


@pytest.fixture
def raw_frame(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r[f.name] for f in schema.PLAYBACK_RAW.fields) for r in rows],
                                     schema.PLAYBACK_RAW)
    return make


@pytest.fixture
def channels(spark):
    rows = [("7", "CH7_HD_E"), ("8", "CH8_Audio"), ("9", "CH9_UHD_E"), ("9", "CH9_Audio"), ("10", "CH10_HVQ_E")]
    return spark.createDataFrame(rows, schema.CHANNEL_DIM)


@pytest.fixture
def no_test_devices(spark):
    return spark.createDataFrame([], schema.TEST_DEVICES)
