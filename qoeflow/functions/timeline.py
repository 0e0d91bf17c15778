"""In-row KPI expressions over the parallel ``bitrate`` / ``clientGeneratedTimestamp`` arrays.

A playback's bitrate timeline is stored in the row itself (``bitrate[i]`` took
effect at ``clientGeneratedTimestamp[i]``), so every KPI is a higher-order
function over the two arrays: no explode, no shuffle, no window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITRATE = "bitrate"
EVENT_TS = "clientGeneratedTimestamp"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def events(bitrate: Column | str = BITRATE, ts: Column | str = EVENT_TS) -> Column:
    """``array<struct<bitrate, clientGeneratedTimestamp>>`` in array order; the shorter array
    is padded with NULL."""
    return F.arrays_zip(_c(bitrate).alias(BITRATE), _c(ts).alias(EVENT_TS))


def time_to_top(top: Column, bitrate: Column | str = BITRATE, ts: Column | str = EVENT_TS,
                start: Column | str = "starttime") -> Column:
    """Seconds from start until the first event at the top rung.

    0 when the type has no ladder or the top is never reached (the best value);
    NULL (row to be dropped) when that event is not after the start.
    """
    pos = F.when(top.isNull(), F.lit(-1)).otherwise(F.array_position(_c(bitrate), top))
    at = F.get(_c(ts), (pos - 1).cast("int"))
    return (
        F.when(pos.isin(-1, 0), F.lit(0.0))
        .when(at > _c(start), (at - _c(start)) / 1000)
        .cast("double")
    )


def startup_ms(ts: Column | str = EVENT_TS, start: Column | str = "starttime") -> Column:
    """Milliseconds from the session start to the first bitrate event."""
    return (F.get(_c(ts), 0) - _c(start)).cast("bigint")


def below_top_between_ms(top: Column, ev: Column) -> Column:
    """Sum of the gaps ``t[i] - t[i-1]`` (i >= 2) whose opening rung ``b[i-1]`` is not the top.

    A missing gap (NULL time) counts 0; a NULL rung counts as below the top. 0 for
    types without a ladder.
    """
    n = F.size(ev)
    k = F.greatest(n - 1, F.lit(0))
    prev, nxt = F.slice(ev, 1, k), F.slice(ev, 2, k)
    gaps = F.zip_with(
        prev,
        nxt,
        lambda p, c: F.when(p[BITRATE] == top, F.lit(0).cast("bigint")).otherwise(
            F.coalesce(c[EVENT_TS] - p[EVENT_TS], F.lit(0).cast("bigint"))
        ),
    )
    total = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda acc, g: acc + g)
    return F.when(top.isNull(), F.lit(0).cast("bigint")).otherwise(total)


def below_top_tail_ms(top: Column, ev: Column, start: Column | str = "starttime",
                      duration: Column | str = "sessionduration") -> Column:
    """Time from the last event to the session end when the last rung is not the top."""
    last = F.element_at(ev, -1)
    tail = _c(start) + _c(duration) - last[EVENT_TS]
    return F.when(last[BITRATE] != top, tail).otherwise(F.lit(0).cast("bigint")).cast("bigint")


def event_gaps(top: Column, ev: Column) -> Column:
    """Per event: ``struct(diff, btp_flag)`` with the gap to the previous event (0 for the
    first) and whether the previous rung was the top (gap then not counted below top)."""
    first = F.array(F.struct(F.lit(0).cast("bigint").alias("diff"), F.lit(0).alias("btp_flag")))
    n = F.size(ev)
    k = F.greatest(n - 1, F.lit(0))
    ts_of = F.transform(ev, lambda e: F.when(top.isNull(), F.lit(0).cast("bigint")).otherwise(e[EVENT_TS]))
    rest = F.zip_with(
        F.zip_with(F.slice(ev, 1, k), F.slice(ts_of, 1, k), lambda e, t: F.struct(e[BITRATE].alias("b"), t.alias("t"))),
        F.slice(ts_of, 2, k),
        lambda p, t: F.struct(
            F.coalesce(t - p["t"], F.lit(0).cast("bigint")).alias("diff"),
            F.when(p["b"] == top, 1).otherwise(0).alias("btp_flag"),
        ),
    )
    return F.concat(first, rest)
