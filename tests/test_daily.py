"""The daily job writes every stage, reads it back and goes on from there."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qoeflow import config, schema
from qoeflow.operators import prep, score
from qoeflow.plans import catalog, daily, stages
from qoeflow.plans.stages import KPIS, Stages
from qoeflow.sources import fixtures as fx
from qoeflow.sources import sinks, tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """One run over a nested feed that lies in a table, by name and path; (paths, lazy plan, day, plans)."""
    place = tmp_path_factory.mktemp("daily")
    fx.playback_raw_nested(spark, SF_SMALL).write.parquet(f"{place}/feed")
    fx.wifi_raw(spark, SF_SMALL).write.parquet(f"{place}/wifi")
    fx.channel_dim(spark, SF_SMALL).write.parquet(f"{place}/channels")
    fx.test_accounts(spark, SF_SMALL).createOrReplaceTempView("lab_devices")
    busiest = (spark.read.parquet(f"{place}/feed").where("eventtype = 'End'").groupBy("received_date").count()
               .orderBy(F.desc("count"), "received_date").first())
    day = busiest["received_date"].isoformat()
    plans = {}
    write = sinks.append_history

    def seen(df, path, *args):
        plans[path.rpartition("/")[2]] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, path, *args)

    sinks.append_history = seen
    try:
        paths = daily.run_tables(spark, day, f"{place}/out", f"{place}/feed", "lab_devices", f"{place}/channels", f"{place}/wifi")
    finally:
        sinks.append_history = write
    raw = schema.flat_playback(spark.read.parquet(f"{place}/feed").where(F.col("received_date") == day))
    lazy = Stages(raw, fx.test_accounts(spark, SF_SMALL), fx.channel_dim(spark, SF_SMALL), fx.wifi_raw(spark, SF_SMALL),
                  config.DEFAULT, day, materialize=False)
    return paths, lazy, day, plans


def read_back(spark, paths, day, names):
    """Stages over the tables the job wrote, so that a test plans one step and not the whole day."""
    st = Stages(None, None, None, fx.wifi_raw(spark, SF_SMALL), config.DEFAULT, day, materialize=False)
    for name in names:
        df = sinks.read_day(spark, paths[name], day)
        if name == "devices":
            st.set_devices(df)
        elif name.startswith("score_"):
            st.set_score_detail(name.split("_")[1], df.withColumn("event_date", F.lit(day)))
        else:
            own = df.withColumn("event_date", F.lit(day)) if name.startswith("combined_") else df
            setattr(st, name.removesuffix("_detail"), own)
    return st


DETAILS = [f"{k}_detail" for k in KPIS]


def same(spark, paths, name, want, day):
    """One pass over each side: number of rows and the sum of their hashes."""
    got, want = sinks.read_day(spark, paths[name], day), want.drop("event_date")
    assert sorted(got.columns) == sorted(want.columns), name

    def print_of(df):
        df = catalog.finish(df.select(*sorted(df.columns)))
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns])
                                               .cast("decimal(38,0)"))).first()
    assert print_of(got) == print_of(want), name


def test_all_tables_are_written(spark, job):
    paths, _, day, _ = job
    assert len(paths) == 1 + 4 + 2 + 24 + 6 + 2
    assert sinks.read_day(spark, paths["base"], day).count() > 0


def test_base_and_details_equal_their_plans(spark, job):
    paths, lazy, day, _ = job
    same(spark, paths, "base", lazy.base, day)
    st = read_back(spark, paths, day, ["base", "stp_detail"])
    for name in KPIS:
        want = st if name != "stp" else read_back(spark, paths, day, ["base"])
        same(spark, paths, f"{name}_detail", want.detail(name), day)


@pytest.mark.parametrize("kpi", list(KPIS))
def test_level_tables_equal_the_roll_up_of_one_kpi(spark, job, kpi):
    """The fused roll-up of all KPIs gives what each KPI's own roll-up gives."""
    paths, _, day, _ = job
    st = read_back(spark, paths, day, DETAILS)
    for level in daily.LEVELS:
        same(spark, paths, f"{kpi}_{level}_hist", st.hist(kpi, level), day)
        same(spark, paths, f"{kpi}_{level}", st.normalized(kpi, level), day)
    assert "sessions" not in st.__dict__


@pytest.mark.parametrize("level", ["device", "account"])
def test_stacked_levels_equal_the_join_of_four(spark, job, level):
    """One conditional aggregate instead of three full joins of the KPIs' level tables."""
    paths, _, day, _ = job
    st = read_back(spark, paths, day, DETAILS)
    parts = [st.level_values(n, level) for n in ("tttp", "ptbtp", "stp", "brs")]
    same(spark, paths, f"combined_{level}", score.combine_levels(*parts, stages.LEVEL_KEYS[level], day), day)


def test_scores_and_wifi_equal_their_plans(spark, job):
    paths, _, day, _ = job
    st = read_back(spark, paths, day, [*DETAILS, "sessions"])
    same(spark, paths, "combined_session", st.combined("session"), day)
    st = read_back(spark, paths, day, [f"combined_{level}" for level in daily.LEVELS])
    for level in daily.LEVELS:
        same(spark, paths, f"score_{level}_detail", st.score_detail(level), day)
    same(spark, paths, "wifi_session_hour", st.wifi_session_hour(day), day)
    same(spark, paths, "wifi_device", st.wifi_device(day), day)


def test_few_exchanges(spark, job):
    """A level is one shuffle, and the session scores need half of the shuffles of a roll-up per KPI."""
    paths, _, day, _ = job
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wide = read_back(spark, paths, day, ["sessions"])
        assert plan(wide.score("device")) == 1 and plan(wide.score("account")) == 2
        st = read_back(spark, paths, day, DETAILS)
        single = sum(plan(st.hist(n, "session")) for n in KPIS)
        assert plan(read_back(spark, paths, day, DETAILS).sessions) * 2 <= single
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_wifi_reduces_before_it_scores(spark):
    """The session-hour join scores only devices with a reading, and gives the rows of the whole day's scores."""
    whole, reduced = catalog.stages(spark, SF_SMALL), catalog.stages(spark, SF_SMALL)
    day = fx.wifi_raw(spark, SF_SMALL).groupBy("received_date").count().orderBy(F.desc("count")).first()["received_date"].isoformat()
    whole.score_detail("session")  # made already: used as it is
    assert whole._seen_by(whole.wifi(day)) is whole
    part = reduced._seen_by(reduced.wifi(day))
    assert 0 < part.base.count() < whole.base.count()
    a, b = whole.wifi_session_hour(day), reduced.wifi_session_hour(day)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    whole.score_detail("device")
    a, b = whole.wifi_device(day), reduced.wifi_device(day)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_no_stage_computes_what_an_earlier_one_wrote(job):
    """Level, score and Wi-Fi stages scan the tables before them, never the feed, the base or a foreign detail."""
    _, _, _, plans = job
    raw_fields = ("playstateChanged", "buffercount", "mediaOpenLatency")
    for name, plan in plans.items():
        if name != "base":
            assert not any(f in plan for f in raw_fields), name
        kpi, _, rest = name.partition("_")
        if kpi in KPIS and rest != "detail" or kpi in ("score", "wifi", "devices"):
            assert "clientGeneratedTimestamp" not in plan and "rungs" not in plan, name
        if name in ("combined_device", "combined_account", "wifi_session_hour", "wifi_device") or rest in ("session", "device", "account"):
            assert "total_session_duration" not in plan and "total_tttp" not in plan, name


def test_missing_field_is_named(spark):
    with pytest.raises(ValueError, match="device.accountSourceId"):
        schema.flat_playback(spark.createDataFrame([(1,)], "x int"))


TEXT_FEED = T.StructType([
    T.StructField(f.name, T.ArrayType(T.StringType()) if f.name in ("bitrate", "clientGeneratedTimestamp")
                  else f.dataType if f.name == "playstateChanged" else T.IntegerType() if f.name == "sessionduration" else T.StringType())
    for f in schema.PLAYBACK_RAW.fields])


def text_row(**kw):
    row = dict(accountSourceId="D6604896516169469", deviceSourceId="18:9C:27:49:BD:0D", bitrate=["1"], eventtype="End",
               starttime="1622841283259", applicationname="STB-XI6", completionstatus="1", assetclass="Linear", sessionduration=300001,
               playstateChanged=[{"value": "initializing"}], pluginSessionId="1", playbackId="1", mediaOpenLatency="1", bufferunderflow="1",
               buffercount="1", bufferratio="1", title="1", clientGeneratedTimestamp=["1622841283269"], received_date="1", az_insert_ts="1")
    row.update(kw)
    return tuple(row[f.name] for f in TEXT_FEED.fields)


def test_feed_of_text_fields(spark):
    """Epochs, counts and array elements that come as text; text that is no number is NULL."""
    rows = [text_row(), text_row(playbackId="2", starttime="null", eventtype="Start", bitrate=["null"], sessionduration=0)]
    flat = schema.flat_playback(spark.createDataFrame(rows, TEXT_FEED))
    assert flat.schema.simpleString() == schema.PLAYBACK_RAW.simpleString()
    got = prep.flatten(prep.prepared(flat)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["starttime"], r["sessionduration"], r["gracenoteId"], r["bitrate"], r["ff_shifts_present"]) == (1622841283259, 300001, None, [1], 0)
    assert (r["clientGeneratedTimestamp_flattened"], r["bitrate_flattened"]) == (1622841283269, 1)
    assert flat.where("playbackId = '2'").first()["starttime"] is None


def test_tables_are_read_by_name_and_path(spark, tmp_path):
    spark.range(3).selectExpr("id", "id % 2 AS g").write.parquet(f"{tmp_path}/t")
    spark.read.parquet(f"{tmp_path}/t").createOrReplaceTempView("t_by_name")
    for source in (f"{tmp_path}/t", "t_by_name"):
        assert tables.get_data(source, ["id"], spark).columns == ["id"]
        assert tables.get_data(source, spark=spark).columns == ["id", "g"]
        assert tables.get_distinct_data(source, ["g"], spark).count() == 2


def test_fixed_values():
    """The thresholds the results depend on, written out once more."""
    c = config.DEFAULT
    assert c.top_bitrate == {"HVQ": 6151600, "HD": 3718000, "SD": 1701200, "UHD": 18597200}
    assert c.stream_type_tokens == ("UHD", "HVQ", "SD", "HD", "Audio", "Enh Audio")
    assert (c.fast_forward_bitrate, c.min_duration_ms, c.max_duration_ms, c.wifi_mac_offset) == (313200, 300000, 7200000, 2)
    assert (c.end_event, c.application, c.asset_class, c.failed_status) == ("End", "STB-XI6", "Linear", "MediaFailed")
    assert (c.playing_states, c.wifi_vendor_prefixes) == (("initializing", "initialized"), ("Technico", "ARRIS"))
    assert [(b.lo, b.hi, b.clip_low) for b in (c.tttp, c.sst, c.ptbtp, c.brs)] == [
        (0.0, 4.0, False), (0.0, 0.00007, False), (0.0, 100.0, True), (0.0, 12.0, True)]
    assert (c.weight_brs, c.weight_ptbtp, c.weight_tttp, c.weight_sst) == (0.4, 0.3, 0.2, 0.1)


def test_the_fixture_exercises_every_rule(spark):
    """Each eligibility predicate rejects a row that all others let pass; every stream type occurs."""
    raw = prep.with_channel_id(fx.playback_raw(spark, "/root/testdata/sf0.01"))
    c = config.DEFAULT
    rules = [f"eventtype = '{c.end_event}'", f"applicationname = '{c.application}'", f"assetclass = '{c.asset_class}'",
             f"sessionduration BETWEEN {c.min_duration_ms} AND {c.max_duration_ms}", "mediaOpenLatency IS NOT NULL",
             "buffercount IS NOT NULL", "bufferratio IS NOT NULL", f"completionstatus <> '{c.failed_status}'", "bitrate IS NOT NULL"]
    counts = raw.select(*[F.count_if(F.expr(" AND ".join([f"NOT ({r})", *(x for x in rules if x != r)]))).alias(f"r{i}")
                          for i, r in enumerate(rules)]).first()
    assert all(n > 0 for n in counts), counts
    assert raw.count() > raw.select("playbackId", "az_insert_ts").distinct().count()
    assert raw.where("exists(bitrate, b -> b IS NULL)").count() and raw.where("size(bitrate) <> size(clientGeneratedTimestamp)").count()
    assert prep.playing(raw).count() < raw.where("playstateChanged IS NOT NULL").count()
    types = {r[0] for r in prep.classify_stream(fx.channel_dim(spark, "/root/testdata/sf0.01")).select("stream_type").distinct().collect()}
    assert types == {*c.stream_type_tokens, config.UNKNOWN_STREAM_TYPE}
