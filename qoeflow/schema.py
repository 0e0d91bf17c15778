"""Explicit schemas of the engine's logical inputs (flat raw layout)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

PLAYBACK_RAW = T.StructType([
    T.StructField("accountSourceId", S),
    T.StructField("deviceSourceId", S),
    T.StructField("pluginSessionId", S),
    T.StructField("playbackId", S),
    T.StructField("eventtype", S),
    T.StructField("applicationname", S),
    T.StructField("assetclass", S),
    T.StructField("completionstatus", S),
    T.StructField("starttime", L),
    T.StructField("sessionduration", L),
    T.StructField("bitrate", T.ArrayType(L)),
    T.StructField("clientGeneratedTimestamp", T.ArrayType(L)),
    T.StructField("playstateChanged", T.ArrayType(T.StructType([T.StructField("value", S)]))),
    T.StructField("mediaOpenLatency", I),
    T.StructField("bufferunderflow", I),
    T.StructField("buffercount", I),
    T.StructField("bufferratio", D),
    T.StructField("title", S),
    T.StructField("received_date", T.DateType()),
    T.StructField("az_insert_ts", T.TimestampNTZType()),
])

# A row's place in its table, where known (``sources.tables.placed``).
PLACE = "_row_place"

# Where the raw feed has the fields of PLAYBACK_RAW.
RAW_PATHS = {
    "accountSourceId": "device.accountSourceId",
    "deviceSourceId": "device.deviceSourceId",
    "pluginSessionId": "session.pluginSessionId",
    "playbackId": "session.playbackId",
    "eventtype": "eventtype",
    "applicationname": "application.applicationname",
    "assetclass": "asset.assetclass",
    "completionstatus": "completionstatus",
    "starttime": "starttime",
    "sessionduration": "sessionduration",
    "bitrate": "bitrateChanged.bitrate",
    "clientGeneratedTimestamp": "bitrateChanged.timing.clientGeneratedTimestamp",
    "playstateChanged": "playstateChanged",
    "mediaOpenLatency": "metrics.mediaOpenLatency",
    "bufferunderflow": "metrics.bufferunderflow",
    "buffercount": "metrics.buffercount",
    "bufferratio": "metrics.bufferratio",
    "title": "asset.title",
    "received_date": "received_date",
    "az_insert_ts": "az_insert_ts",
}

TEST_DEVICES = T.StructType([T.StructField("deviceSourceId", S)])

CHANNEL_DIM = T.StructType([T.StructField("source_id", S), T.StructField("ts_name", S)])

WIFI_RAW = T.StructType([
    T.StructField("HHID", S),
    T.StructField("GW_MAC_ADDRESS", S),
    T.StructField("DEVICE_MAC", S),
    T.StructField("DEVICE_VENDOR", S),
    T.StructField("DEVICE_TAG", S),
    T.StructField("LAST_24H_MEDIAN_DEVICE_RSSI", D),
    T.StructField("CURRENT_HR_DEVICE_RSSI", D),
    T.StructField("CURRENT_HR_DEVICE_SNR", L),
    T.StructField("CURRENT_HR_DEVICE_RX", L),
    T.StructField("CURRENT_HR_DEVICE_TX", L),
    T.StructField("CURRENT_HR_DEVICE_RET", L),
    T.StructField("WIFI_HAPPINESS_INDEX", I),
    T.StructField("DATE_TIME", T.TimestampNTZType()),
    T.StructField("received_date", T.DateType()),
])


def flat_playback(raw: DataFrame) -> DataFrame:
    """The raw feed, nested as it comes or already flat, as typed ``PLAYBACK_RAW`` columns (and ``PLACE``,
    where the feed has it).

    Fields that come as text (epochs, counts, also inside arrays) are cast; text that is no value of
    the type becomes NULL. On parquet only the nested fields named here are read.
    """
    have = {f.name.lower(): f.dataType for f in raw.schema.fields}

    def there(path: str) -> bool:
        kind, fields = None, have
        for part in path.lower().split("."):
            if part not in fields:
                return False
            kind = fields[part]
            fields = {f.name.lower(): f.dataType for f in kind.fields} if isinstance(kind, T.StructType) else {}
        return True

    cols = []
    for f in PLAYBACK_RAW.fields:
        path = next((p for p in (RAW_PATHS[f.name], f.name) if there(p)), None)
        if path is None:
            raise ValueError(f"missing column {RAW_PATHS[f.name]}")
        cols.append(F.col(path).try_cast(f.dataType).alias(f.name))
    return raw.select(*cols, *[F.col(PLACE)] * (PLACE in raw.columns))


def check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, failing early when one is missing or of
    another type (names compare case-insensitively, like Spark)."""
    have = {f.name.lower(): f for f in df.schema.fields}
    for f in schema.fields:
        got = have.get(f.name.lower())
        if got is None:
            raise ValueError(f"missing column {f.name}")
        if got.dataType.simpleString() != f.dataType.simpleString():  # nullability aside
            raise TypeError(f"column {f.name}: expected {f.dataType.simpleString()}, got {got.dataType.simpleString()}")
    return df.select(*[f.name for f in schema.fields])
