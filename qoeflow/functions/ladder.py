"""Column expressions over one playback row: channel id, stream type, ladder top."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qoeflow.config import DEFAULT, UNKNOWN_STREAM_TYPE, QoeConfig


def channel_id(title: Column | str) -> Column:
    """Second ``:``-separated field of the asset title; NULL when there is none."""
    return F.get(F.split(F.col(title) if isinstance(title, str) else title, ":"), 1)


def stream_type(ts_name: Column | str, cfg: QoeConfig = DEFAULT) -> Column:
    """First stream-type token (in priority order) among the ``_``-separated parts of a
    transport-stream name, else ``unknown``."""
    name = F.col(ts_name) if isinstance(ts_name, str) else ts_name
    tokens = F.split(name, "[_]")
    expr = None
    for token in cfg.stream_type_tokens:
        hit = F.array_contains(tokens, token)
        expr = F.when(hit, token) if expr is None else expr.when(hit, token)
    return expr.otherwise(UNKNOWN_STREAM_TYPE)


def top_bitrate(stream: Column | str, cfg: QoeConfig = DEFAULT) -> Column:
    """Top rung of the stream type's ladder; NULL for types without a ladder."""
    st = F.col(stream) if isinstance(stream, str) else stream
    expr = None
    for name, rate in cfg.top_bitrate.items():
        expr = F.when(st == name, F.lit(rate)) if expr is None else expr.when(st == name, F.lit(rate))
    return expr.cast("bigint")
