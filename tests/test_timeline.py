"""The in-row (closed-form) below-top computation against (a) a row-wise lag window and
(b) a plain-Python brute force on random timelines."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from qoeflow.config import DEFAULT, TOP_BITRATE
from qoeflow.functions import timeline as tl
from qoeflow.functions.ladder import top_bitrate
from qoeflow.operators import kpi
from qoeflow.plans import catalog
from tests.conftest import SF_SMALL


def windowed_parts(rows):
    """Row-wise form: explode events, lag over the playback row, sum flagged gaps."""
    top = top_bitrate("stream_type")
    r = rows.withColumn("rid", F.monotonically_increasing_id())
    ev = r.select("rid", "stream_type", "starttime", "sessionduration", top.alias("top"),
                  F.posexplode(tl.events()).alias("pos", "e"))
    ev = ev.withColumn("t", F.when(F.col("top").isNull(), F.lit(0)).otherwise(F.col("e")[tl.EVENT_TS]))
    w = Window.partitionBy("rid").orderBy("pos")
    ev = ev.withColumn("prev_t", F.lag("t").over(w)).withColumn("prev_b", F.lag(F.col("e")[tl.BITRATE]).over(w))
    ev = ev.withColumn("diff", F.coalesce(F.col("t") - F.col("prev_t"), F.lit(0)))
    ev = ev.withColumn("flag", F.when(F.col("prev_b") == F.col("top"), 1).otherwise(0))
    mid = ev.where("flag = 0").groupBy("rid").agg(F.sum("diff").alias("mid"))
    last = ev.withColumn("n", F.max("pos").over(Window.partitionBy("rid"))).where("pos = n").select(
        "rid", F.when(F.col("e")[tl.BITRATE] != F.col("top"),
                      F.col("starttime") + F.col("sessionduration") - F.col("t")).otherwise(0).alias("tail"))
    return r.join(mid, "rid").join(last, "rid")


def test_closed_form_equals_window_form(spark):
    base = catalog.stages(spark, SF_SMALL, materialize=False).base
    rows = kpi.ptbtp_input(base)
    top = top_bitrate("stream_type")
    closed = rows.select(*kpi.PTBTP_INPUT, tl.below_top_between_ms(top, tl.events()).alias("mid_c"),
                         tl.below_top_tail_ms(top, tl.events()).alias("tail_c"))
    w = windowed_parts(closed)
    bad = w.where((F.col("mid") != F.col("mid_c")) | (F.col("tail") != F.col("tail_c"))).count()
    assert w.count() == rows.count() > 0
    assert bad == 0


def brute(stream, start, dur, bitrate, ts):
    top = TOP_BITRATE.get(stream)
    if top is None:
        return 0, 0
    mid = sum(ts[i] - ts[i - 1] for i in range(1, len(ts)) if bitrate[i - 1] != top)
    tail = start + dur - ts[-1] if bitrate[-1] != top else 0
    return mid, tail


def test_closed_form_against_brute_force(spark):
    rnd = random.Random(7)
    rungs = [313200, 850000, 1701200, 3718000, 6151600, 18597200]
    rows = []
    for i in range(400):
        n = rnd.randint(1, 12)
        start = rnd.randint(0, 10**9)
        ts = sorted(start + rnd.randint(-5000, 3_000_000) for _ in range(n))
        rows.append((i, rnd.choice(["HD", "SD", "HVQ", "UHD", "Audio", "unknown"]), start,
                     rnd.randint(300000, 7200000), [rnd.choice(rungs) for _ in range(n)], ts))
    df = spark.createDataFrame(rows, "id long, stream_type string, starttime long, sessionduration long, "
                                     "bitrate array<long>, clientGeneratedTimestamp array<long>")
    top = top_bitrate("stream_type", DEFAULT)
    got = {r["id"]: (r["mid"], r["tail"]) for r in df.select(
        "id", tl.below_top_between_ms(top, tl.events()).alias("mid"),
        tl.below_top_tail_ms(top, tl.events()).alias("tail")).collect()}
    for i, stream, start, dur, b, t in rows:
        assert got[i] == brute(stream, start, dur, b, t), (stream, b, t)
