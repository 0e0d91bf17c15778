"""Thresholds, ladders and weights of the playback-quality score.

Everything the jobs compare against lives in one frozen object so a run can be
re-tuned without touching operator code. ``QoeConfig()`` gives the production
defaults; tests and the oracle also use ``FIXTURE_TUNING`` whose bounds put the
fixture values on both sides of every clip.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values (must equal the reference's for right results) -------------
# Top bitrate (bits/s) of each stream type's ladder; types absent here have no
# ladder (Audio, Enh Audio, unknown).
TOP_BITRATE = {"HVQ": 6151600, "HD": 3718000, "SD": 1701200, "UHD": 18597200}
# Stream-type tokens of a transport-stream name, in priority order.
STREAM_TYPE_TOKENS = ("UHD", "HVQ", "SD", "HD", "Audio", "Enh Audio")
UNKNOWN_STREAM_TYPE = "unknown"
# Bitrate rung that marks fast-forward / trick play.
FAST_FORWARD_BITRATE = 313200
# Playback eligibility.
END_EVENT = "End"
APPLICATION = "STB-XI6"
ASSET_CLASS = "Linear"
FAILED_STATUS = "MediaFailed"
PLAYING_STATES = ("initializing", "initialized")
MIN_DURATION_MS = 300000
MAX_DURATION_MS = 7200000
# KPI bounds for min-max normalization.
TTTP_MIN, TTTP_MAX = 0.0, 4.0  # seconds
SST_MIN, SST_MAX = 0.0, 0.00007  # fraction of the session duration
PTBTP_MIN, PTBTP_MAX = 0.0, 100.0  # percent
BRS_MIN, BRS_MAX = 0.0, 12.0  # bitrate values per playback
# Score weights.
WEIGHT_BRS, WEIGHT_PTBTP, WEIGHT_TTTP, WEIGHT_SST = 0.4, 0.3, 0.2, 0.1
# Wi-Fi gateways whose telemetry is trusted.
WIFI_VENDOR_PREFIXES = ("Technico", "ARRIS")
# A Wi-Fi MAC is the video MAC plus two.
WIFI_MAC_OFFSET = 2
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    lo: float
    hi: float
    clip_low: bool


@dataclass(frozen=True)
class QoeConfig:
    top_bitrate: dict = field(default_factory=lambda: dict(TOP_BITRATE))
    stream_type_tokens: tuple = STREAM_TYPE_TOKENS
    fast_forward_bitrate: int = FAST_FORWARD_BITRATE
    end_event: str = END_EVENT
    application: str = APPLICATION
    asset_class: str = ASSET_CLASS
    failed_status: str = FAILED_STATUS
    playing_states: tuple = PLAYING_STATES
    min_duration_ms: int = MIN_DURATION_MS
    max_duration_ms: int = MAX_DURATION_MS
    tttp: Bounds = Bounds(TTTP_MIN, TTTP_MAX, clip_low=False)
    sst: Bounds = Bounds(SST_MIN, SST_MAX, clip_low=False)
    ptbtp: Bounds = Bounds(PTBTP_MIN, PTBTP_MAX, clip_low=True)
    brs: Bounds = Bounds(BRS_MIN, BRS_MAX, clip_low=True)
    weight_brs: float = WEIGHT_BRS
    weight_ptbtp: float = WEIGHT_PTBTP
    weight_tttp: float = WEIGHT_TTTP
    weight_sst: float = WEIGHT_SST
    wifi_vendor_prefixes: tuple = WIFI_VENDOR_PREFIXES
    wifi_mac_offset: int = WIFI_MAC_OFFSET
    # Startup-time rows are taken per base-table row, like the reference; set
    # True for one row per playback instead.
    sst_dedupe: bool = False

    def with_bounds(self, **bounds: Bounds) -> "QoeConfig":
        return replace(self, **bounds)


DEFAULT = QoeConfig()
# Looser bounds so the fixture data lands on both sides of each clip.
FIXTURE_TUNING = DEFAULT.with_bounds(
    tttp=Bounds(0.0, 60.0, clip_low=False),
    sst=Bounds(0.0, 0.05, clip_low=False),
    brs=Bounds(0.0, 8.0, clip_low=True),
)
