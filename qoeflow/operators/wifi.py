"""Wi-Fi gateway telemetry joined to the scores for diagnosis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qoeflow.config import DEFAULT, QoeConfig

WIFI_COLUMNS = [
    "HHID", "GW_MAC_ADDRESS", "DEVICE_MAC", "DEVICE_VENDOR", "DEVICE_TAG", "LAST_24H_MEDIAN_DEVICE_RSSI",
    "CURRENT_HR_DEVICE_RSSI", "CURRENT_HR_DEVICE_SNR", "WIFI_HAPPINESS_INDEX", "CURRENT_HR_DEVICE_RX",
    "CURRENT_HR_DEVICE_TX", "CURRENT_HR_DEVICE_RET", "received_date", "DATE_TIME",
]
METRICS = [
    "LAST_24H_MEDIAN_DEVICE_RSSI", "CURRENT_HR_DEVICE_RSSI", "CURRENT_HR_DEVICE_SNR", "CURRENT_HR_DEVICE_RX",
    "CURRENT_HR_DEVICE_TX", "CURRENT_HR_DEVICE_RET", "WIFI_HAPPINESS_INDEX",
]


def video_mac(wifi_mac: Column | str, cfg: QoeConfig = DEFAULT) -> Column:
    """WIF2: the set-top box MAC (12 hex digits, no colons) behind a Wi-Fi client MAC.

    The video interface is the Wi-Fi MAC minus two; leading zeros lost by the
    arithmetic are padded back.
    """
    mac = F.col(wifi_mac) if isinstance(wifi_mac, str) else wifi_mac
    num = F.conv(mac, 16, 10).cast("bigint") - cfg.wifi_mac_offset
    return F.lpad(F.conv(num.cast("string"), 10, 16), 12, "0")


def plain_mac(device_id: Column | str) -> Column:
    """Score-side device id without colons."""
    d = F.col(device_id) if isinstance(device_id, str) else device_id
    return F.regexp_replace(d, ":", "")


def wifi_slice(wifi: DataFrame, run_date: str | None = None, cfg: QoeConfig = DEFAULT) -> DataFrame:
    """WIF1: trusted gateways (vendor prefixes), one day when ``run_date`` is given, with
    the hour of the reading and the aligned device id."""
    df = wifi.select(*WIFI_COLUMNS)
    if run_date is not None:
        df = df.where(F.col("received_date") == F.lit(run_date[:10]).cast("date"))
    vendor = None
    for prefix in cfg.wifi_vendor_prefixes:
        cond = F.col("DEVICE_VENDOR").startswith(prefix)
        vendor = cond if vendor is None else vendor | cond
    df = df.where(vendor)
    return df.withColumn("hour", F.hour("DATE_TIME")).withColumn("deviceSourceId", video_mac("DEVICE_MAC", cfg))


SESSION_HOUR_COLUMNS = [
    "deviceSourceId", "pluginSessionId", "playbackId", "tttp", "az_insert_ts", "sessionduration", "stream_type",
    "time_below_top_profile", "time_at_top_profile", "percentage_below_top_profile", "total_shifts", "starttime",
    "stp_time", "percentage_of_stp_time", "DEVICE_VENDOR", "DEVICE_TAG", "LAST_24H_MEDIAN_DEVICE_RSSI",
    "CURRENT_HR_DEVICE_RSSI", "CURRENT_HR_DEVICE_SNR", "CURRENT_HR_DEVICE_RX", "CURRENT_HR_DEVICE_TX",
    "CURRENT_HR_DEVICE_RET", "WIFI_HAPPINESS_INDEX", "hour", "session_score", "received_date",
]


def session_hour(scored: DataFrame, wifi: DataFrame, with_account: bool = False) -> DataFrame:
    """WIF3: scored playbacks joined to the gateway reading of the same device and hour of
    day (of the ingest time). ``wifi`` is one day's slice, so a device-hour has few readings and
    the output grows with the days, not with their square; ``scored`` is distinct already."""
    left = (
        scored.withColumn("hour", F.hour("az_insert_ts"))
        .withColumn("deviceSourceId", plain_mac("deviceSourceId"))
    )
    on = ["deviceSourceId", "hour"]
    right = wifi
    if with_account:
        right = wifi.withColumnRenamed("HHID", "accountSourceId")
        on = on + ["accountSourceId"]
    cols = SESSION_HOUR_COLUMNS + (["accountSourceId"] if with_account else [])
    return left.join(right, on, "inner").select(*cols)


def device_max(wifi: DataFrame) -> DataFrame:
    """WIF4: per account and device, the maximum of each reading independently."""
    cols = METRICS + ["DEVICE_VENDOR", "DEVICE_TAG", "received_date", "DATE_TIME"]
    return (
        wifi.withColumnRenamed("HHID", "accountSourceId")
        .groupBy("accountSourceId", "deviceSourceId")
        .agg(*[F.max(c).alias(c) for c in cols])
    )


DEVICE_COLUMNS = [
    "accountSourceId", "deviceSourceId", "weighted_average_tttp", "weighted_average_bitrate",
    "weighted_average_ptbtp", "weighted_average_stp", "DEVICE_VENDOR", "DEVICE_TAG",
    "LAST_24H_MEDIAN_DEVICE_RSSI", "CURRENT_HR_DEVICE_RSSI", "CURRENT_HR_DEVICE_SNR", "CURRENT_HR_DEVICE_RX",
    "CURRENT_HR_DEVICE_TX", "CURRENT_HR_DEVICE_RET", "WIFI_HAPPINESS_INDEX", "device_score", "received_date",
]


def device_join(scored: DataFrame, maxima: DataFrame) -> DataFrame:
    """WIF5: device scores with the device's Wi-Fi maxima (joined on the device only)."""
    left = scored.withColumn("deviceSourceId", plain_mac("deviceSourceId")).distinct()
    right = maxima.drop("accountSourceId")
    return left.join(right, "deviceSourceId", "inner").select(*DEVICE_COLUMNS).distinct()
