"""The reference's unit cases plus hand-computed ones (see FIXTURES.md §5)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from qoeflow.config import DEFAULT
from qoeflow.operators import prep, wifi
from qoeflow.plans.stages import Stages
from tests.conftest import playback


def stages(raw, channels, no_test_devices, **kw):
    return Stages(raw, no_test_devices, channels, None, DEFAULT, "2021-09-15", materialize=False, **kw)


def test_ineligible_row_gives_nothing(raw_frame):
    raw = raw_frame([playback(eventtype="Start", sessionduration=0)])
    assert prep.prepared(raw).count() == 0


def test_eligible_row_without_channel_in_title(raw_frame):
    raw = raw_frame([playback(title="1", bitrate=[1], clientGeneratedTimestamp=[1000010], sessionduration=300001)])
    rows = prep.flatten(prep.prepared(raw)).collect()
    assert len(rows) == 1
    assert rows[0]["gracenoteId"] is None
    assert rows[0]["ff_shifts_present"] == 0
    assert rows[0]["bitrate_flattened"] == 1 and rows[0]["clientGeneratedTimestamp_flattened"] == 1000010


def test_top_at_first_event(raw_frame, channels, no_test_devices):
    raw = raw_frame([playback(starttime=1631733523496, bitrate=[3718000], clientGeneratedTimestamp=[1631733523817])])
    tttp = stages(raw, channels, no_test_devices).tttp.collect()
    assert [r["tttp"] for r in tttp] == [0.321]


def test_below_at_below(raw_frame, channels, no_test_devices):
    s = stages(raw_frame([playback()]), channels, no_test_devices)
    assert s.tttp.first()["tttp"] == 12.0
    stp = s.stp.first()
    assert stp["stp_time"] == 2000 and round(stp["percentage_of_stp_time"], 6) == 0.003333
    p = s.ptbtp.first()
    assert p["time_below_top_profile"] == 310000
    assert p["percentage_below_top_profile"] == 51.839
    assert p["time_at_top_profile"] == 292000
    assert s.brs.first()["total_shifts"] == 3
    assert round(s.score("session").first()["session_score"], 4) == 44.4483


def test_all_at_top_single_event_is_kept(raw_frame, channels, no_test_devices):
    s = stages(raw_frame([playback(bitrate=[3718000], clientGeneratedTimestamp=[1002000])]), channels,
               no_test_devices)
    assert [r["percentage_below_top_profile"] for r in s.ptbtp.collect()] == [0.0]


def test_no_ladder_counts_as_best(raw_frame, channels, no_test_devices):
    s = stages(raw_frame([playback(title="lin:8")]), channels, no_test_devices)
    assert [r["tttp"] for r in s.tttp.collect()] == [0.0]
    assert [r["percentage_below_top_profile"] for r in s.ptbtp.collect()] == [0.0]


def test_channel_fan_out_keeps_each_stream(raw_frame, channels, no_test_devices):
    s = stages(raw_frame([playback(title="lin:9")]), channels, no_test_devices)
    assert sorted(r["stream_type"] for r in s.tttp.collect()) == ["Audio", "UHD"]


def test_fast_forward_only_playback_is_dropped(raw_frame):
    raw = raw_frame([playback(bitrate=[313200, 313200]), playback(playbackId="p2", bitrate=[313200, 850000])])
    assert [r["playbackId"] for r in prep.prepared(raw).collect()] == ["p2"]


def test_test_devices_are_removed(spark, raw_frame, channels):
    test = spark.createDataFrame([("AA:BB:CC:DD:EE:01",)], "deviceSourceId string")
    raw = raw_frame([playback(), playback(deviceSourceId="AA:BB:CC:DD:EE:02", playbackId="p2")])
    base = prep.playback_base(raw, test, channels)
    assert [r["playbackId"] for r in base.collect()] == ["p2"]


@pytest.mark.parametrize("mac,expected", [("0A1095AABB01", "0A1095AABAFF"), ("E0371753A0C3", "E0371753A0C1"),
                                          ("000000000102", "000000000100")])
def test_mac_alignment_keeps_leading_zeros(spark, mac, expected):
    got = spark.range(1).select(wifi.video_mac(F.lit(mac)).alias("m")).first()["m"]
    assert got == expected


@pytest.mark.parametrize("name,stream", [("CH1_UHD_HD", "UHD"), ("X_SD", "SD"), ("X_HD_E", "HD"),
                                         ("X_Enh Audio", "Enh Audio"), ("X_HDR", "unknown"), ("HVQ", "HVQ")])
def test_stream_type_classifier(spark, name, stream):
    dim = spark.createDataFrame([("1", name)], "source_id string, ts_name string")
    assert prep.classify_stream(dim).first()["stream_type"] == stream
