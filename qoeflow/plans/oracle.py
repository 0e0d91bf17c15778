"""DuckDB oracle: the same questions as ``catalog`` written as plain SQL in the flat,
row-at-a-time style (explode, global de-duplication, window lag, self joins), so it
checks the compact Spark plan rather than mirroring it.

Views ``region nation customer supplier part orders lineitem events ...`` are
registered by the caller. ``FIXTURE_SQL`` derives the playback feed, test devices,
channel dimension and Wi-Fi feed exactly as ``qoeflow.sources.fixtures``.
"""

from __future__ import annotations

from qoeflow.config import DEFAULT, FIXTURE_TUNING, QoeConfig

RUN_DATE = "1998-10-03"
WIFI_DAY = "2024-01-10"
HISTORY_DAYS = ("1995-07-12", "1997-02-01")

FIXTURE_SQL = r"""
ev AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         CAST(sum(l_quantity) OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice
              ROWS UNBOUNDED PRECEDING) * 1000 AS BIGINT) - 3000 AS off_ms,
         CAST(CASE l_partkey % 4 WHEN 0 THEN 313200 WHEN 1 THEN 850000 ELSE
           CASE l_orderkey % 4 WHEN 0 THEN 3718000 WHEN 1 THEN 6151600
                               WHEN 2 THEN 1701200 ELSE 18597200 END END AS BIGINT) AS br
  FROM lineitem
), arr AS (
  SELECT l_orderkey,
         list(br     ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS bitrate,
         list(off_ms ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS offs,
         list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)[1] AS channel
  FROM ev GROUP BY l_orderkey
), cust AS (
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_custkey % 5 = 0 THEN 70000000000 ELSE 246512345000000 END
           + c_custkey * 4096 AS mac_num
  FROM customer
), playback_raw AS (
  SELECT 'a' || (o_custkey // 3) AS accountSourceId,
         regexp_replace(lpad(upper(hex(mac_num)), 12, '0'),
           '(..)(..)(..)(..)(..)(..)', '\1:\2:\3:\4:\5:\6') AS deviceSourceId,
         's' || o_custkey || '_' || year(o_orderdate) AS pluginSessionId,
         'p' || o_orderkey AS playbackId,
         CASE o_orderstatus WHEN 'P' THEN 'Start' ELSE 'End' END AS eventtype,
         CASE WHEN o_orderkey % 19 = 0 THEN 'STB-OTHER' ELSE 'STB-XI6' END AS applicationname,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'VOD' ELSE 'Linear' END AS assetclass,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'MediaFailed' ELSE 'Success' END AS completionstatus,
         epoch_ms(o_orderdate) AS starttime,
         200000 + (o_orderkey * 7919) % 7400000 AS sessionduration,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL
              WHEN o_orderkey % 41 = 0 THEN list_prepend(CAST(NULL AS BIGINT), bitrate[2:])
              WHEN o_orderkey % 37 = 0 THEN list_append(bitrate, CAST(850000 AS BIGINT))
              ELSE bitrate END AS bitrate,
         list_transform(CASE WHEN o_orderkey % 43 = 0 THEN list_append(offs, offs[-1] + 60000) ELSE offs END,
                        lambda x: x + epoch_ms(o_orderdate)) AS clientGeneratedTimestamp,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              WHEN o_orderkey % 12 = 1 THEN [{'value': 'playing'}]
              WHEN o_orderkey % 12 = 2 THEN [{'value': 'playing'}, {'value': 'initialized'}]
              ELSE [{'value': 'initializing'}, {'value': 'initialized'}, {'value': 'playing'}] END AS playstateChanged,
         CAST(CASE WHEN o_orderkey % 17 <> 0 THEN 1 END AS INTEGER) AS mediaOpenLatency,
         CAST(0 AS INTEGER) AS bufferunderflow,
         CAST(CASE WHEN o_orderkey % 23 <> 0 THEN 1 END AS INTEGER) AS buffercount,
         CAST(CASE WHEN o_orderkey % 29 <> 0 THEN 0.5 END AS DOUBLE) AS bufferratio,
         'lin:' || channel AS title,
         CAST(o_orderdate AS DATE) AS received_date,
         o_orderdate + to_hours(CAST((o_orderkey + late.hours) % 24 AS INTEGER)) AS az_insert_ts
  FROM orders JOIN cust ON o_custkey = c_custkey JOIN arr ON l_orderkey = o_orderkey,
       unnest(CASE WHEN o_orderkey % 53 = 0 THEN [0, 1] WHEN o_orderkey % 13 = 0 THEN [0, 0] ELSE [0] END) AS late(hours)
), test_accounts AS (
  SELECT regexp_replace(lpad(upper(hex(mac_num)), 12, '0'),
           '(..)(..)(..)(..)(..)(..)', '\1:\2:\3:\4:\5:\6') AS deviceSourceId
  FROM cust WHERE c_custkey % 50 = 7
), channel_dim AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS source_id,
         'CH' || s_suppkey || '_' || CASE WHEN s_suppkey % 50 = 3 THEN '4K' WHEN s_suppkey % 4 = 0 THEN 'HD'
                                          WHEN s_suppkey % 4 = 1 THEN 'HVQ' WHEN s_suppkey % 4 = 2 THEN 'SD'
                                          ELSE 'UHD' END || '_E' AS ts_name
  FROM supplier WHERE s_suppkey % 10 <> 9
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), 'CH' || s_suppkey || CASE WHEN s_suppkey % 20 = 5 THEN '_Audio' ELSE '_Enh Audio' END
  FROM supplier WHERE s_suppkey % 10 = 5
), wifi_raw AS (
  SELECT 'a' || (user_id // 3) AS HHID,
         lpad(upper(hex(mac_num + 1)), 12, '0') AS GW_MAC_ADDRESS,
         lpad(upper(hex(mac_num + 2)), 12, '0') AS DEVICE_MAC,
         CASE event_type WHEN 'view' THEN 'Technicolor' WHEN 'click' THEN 'ARRIS' ELSE 'Other' END AS DEVICE_VENDOR,
         event_type AS DEVICE_TAG,
         -(value + 20.0) AS LAST_24H_MEDIAN_DEVICE_RSSI,
         -value AS CURRENT_HR_DEVICE_RSSI,
         event_id % 40 AS CURRENT_HR_DEVICE_SNR,
         event_id * 7 % 1000 AS CURRENT_HR_DEVICE_RX,
         event_id * 13 % 1000 AS CURRENT_HR_DEVICE_TX,
         event_id % 9 AS CURRENT_HR_DEVICE_RET,
         CAST(json_extract(props, '$.k') AS INTEGER) AS WIFI_HAPPINESS_INDEX,
         ts AS DATE_TIME, CAST(ts AS DATE) AS received_date
  FROM events JOIN cust ON user_id = c_custkey
)"""

K4 = "accountSourceId, deviceSourceId, pluginSessionId, playbackId"
K3 = "accountSourceId, deviceSourceId, pluginSessionId"
K2 = "accountSourceId, deviceSourceId"


def sround(x: str, n: int) -> str:
    """Spark's ``round(double, n)``: half-up on the shortest decimal text of the double
    (DuckDB's own ``round`` works on the binary value and differs at half-way points)."""
    x = f"CAST({x} AS DOUBLE)"
    exact = f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {n}) AS DOUBLE)"
    return f"(CASE WHEN isfinite({x}) AND abs({x}) < 1e17 THEN {exact} ELSE {x} END)"


def _top(cfg: QoeConfig, col: str = "stream_type") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in cfg.top_bitrate.items())
    return f"CAST(CASE {col} {whens} END AS BIGINT)"


def _stream_type(cfg: QoeConfig) -> str:
    whens = " ".join(
        f"WHEN list_contains(string_split_regex(ts_name, '[_]'), '{t}') THEN '{t}'" for t in cfg.stream_type_tokens
    )
    return f"CASE {whens} ELSE 'unknown' END"


def _clip(v: str, b) -> str:
    if b.clip_low:
        return f"CASE WHEN {v} <= {b.lo!r} THEN {b.lo!r} WHEN {v} >= {b.hi!r} THEN {b.hi!r} ELSE {v} END"
    return f"CASE WHEN {v} > {b.hi!r} THEN {b.hi!r} ELSE {v} END"


def exact(x: str, places: int) -> str:
    """A double as a decimal, by its shortest text, so that sums don't depend on their order."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(28, {places}))"


def mean(x: str) -> str:
    """As ``rollup.mean``: an exact sum of values taken to 15 places, over their number."""
    return f"CAST(sum({exact(x, 15)}) AS DOUBLE) / count({x})"


def _session(name: str, detail: str, value: str, out: str, nonneg: bool) -> str:
    having = "HAVING sum(term) >= 0" if nonneg else ""
    w = sround("d.sessionduration / t.total", 10)
    return f"""{name} AS (
  SELECT {K3}, CAST(sum(term) AS DOUBLE) AS {out}, '{RUN_DATE}' AS event_date
  FROM (SELECT {K3}, {exact("x", 10)} AS term FROM (SELECT {K3},
          CAST(CASE WHEN {w} = 1.0 THEN d.{value}
               ELSE {sround(f"d.{value} * {w}", 10)} END AS DOUBLE) AS x
        FROM {detail} d
        JOIN (SELECT {K3}, sum(sessionduration) AS total FROM {detail} GROUP BY {K3}) t USING ({K3})))
  GROUP BY {K3} {having})"""


KPI_SQL = {
    # name: (detail view, value column, avg column, norm column, bounds attr, keep non-negative)
    "tttp": ("tttp_detail", "tttp", "weighted_average_tttp", "normalized_tttp", "tttp", True),
    "stp": ("sst_detail", "percentage_of_stp_time", "weighted_average_stp", "normalized_stp", "sst", True),
    "ptbtp": ("ptbtp_detail", "percentage_below_top_profile", "weighted_average_ptbtp",
              "normalized_weighted_average_ptbtp", "ptbtp", True),
    "brs": ("brs_detail", "total_shifts", "weighted_average_bitrate", "normalized_weighted_average_bitrate", "brs",
            False),
}


def stage_sql(cfg: QoeConfig = DEFAULT) -> str:
    """All CTEs of the daily job (after ``FIXTURE_SQL``)."""
    ff = cfg.fast_forward_bitrate
    states = ", ".join(f"'{s}'" for s in cfg.playing_states)
    parts = [f"""
flat13 AS (
  SELECT DISTINCT r.accountSourceId, r.deviceSourceId, r.starttime, r.sessionduration,
         string_split(r.title, ':')[2] AS gracenoteId, r.bitrate, r.pluginSessionId, r.playbackId,
         CASE WHEN b.x = {ff} THEN 1 ELSE 0 END AS ff_shifts_present,
         t.x AS clientGeneratedTimestamp_flattened, r.clientGeneratedTimestamp, b.x AS bitrate_flattened,
         r.az_insert_ts
  FROM playback_raw r, unnest(r.bitrate) AS b(x), unnest(r.playstateChanged) AS p(s),
       unnest(r.clientGeneratedTimestamp) AS t(x)
  WHERE r.playstateChanged IS NOT NULL
    AND r.eventtype = '{cfg.end_event}' AND r.applicationname = '{cfg.application}'
    AND r.assetclass = '{cfg.asset_class}'
    AND p.s.value IN ({states})
    AND t.x > r.starttime
    AND r.sessionduration >= {cfg.min_duration_ms} AND r.sessionduration <= {cfg.max_duration_ms}
    AND r.mediaOpenLatency IS NOT NULL AND r.buffercount IS NOT NULL AND r.bufferratio IS NOT NULL
    AND r.completionstatus <> '{cfg.failed_status}' AND r.bitrate IS NOT NULL
), prepped AS (
  SELECT * FROM flat13 WHERE ff_shifts_present = 0
), no_test AS (
  SELECT * FROM prepped p
  WHERE NOT EXISTS (SELECT 1 FROM test_accounts t WHERE t.deviceSourceId = p.deviceSourceId)
), chan AS (
  SELECT source_id AS gracenoteId, ts_name, {_stream_type(cfg)} AS stream_type FROM channel_dim
), base AS (
  SELECT p.gracenoteId, p.accountSourceId, p.deviceSourceId, p.starttime, p.sessionduration, p.bitrate,
         p.pluginSessionId, p.playbackId, p.ff_shifts_present, p.clientGeneratedTimestamp_flattened,
         p.clientGeneratedTimestamp, p.bitrate_flattened, p.az_insert_ts, c.ts_name, c.stream_type
  FROM no_test p JOIN chan c ON p.gracenoteId = c.gracenoteId
), tttp_pos AS (
  SELECT *, CASE WHEN top IS NULL THEN -1 ELSE coalesce(list_position(bitrate, top), 0) END AS pos
  FROM (SELECT DISTINCT accountSourceId, deviceSourceId, sessionduration, stream_type, starttime, pluginSessionId,
               playbackId, clientGeneratedTimestamp, bitrate, az_insert_ts, {_top(cfg)} AS top FROM base)
), tttp_detail AS (
  SELECT {K4}, starttime, sessionduration, stream_type, tttp, az_insert_ts
  FROM (SELECT *, CASE WHEN pos IN (-1, 0) THEN CAST(0 AS DOUBLE)
                       WHEN clientGeneratedTimestamp[pos] > starttime
                       THEN (clientGeneratedTimestamp[pos] - starttime) / 1000 END AS tttp
        FROM tttp_pos)
  WHERE tttp IS NOT NULL
), sst_detail AS (
  SELECT {K4}, starttime, sessionduration, bitrate[1] AS stp_bitrate,
         clientGeneratedTimestamp[1] AS stp_clientgeneratedtimestamp,
         clientGeneratedTimestamp[1] - starttime AS stp_time,
         (clientGeneratedTimestamp[1] - starttime) / sessionduration AS percentage_of_stp_time
  FROM base
  WHERE (clientGeneratedTimestamp[1] - starttime) / sessionduration >= 0
    AND clientGeneratedTimestamp[1] - starttime >= 0
), ptbtp_rows AS (
  SELECT row_number() OVER () AS rid, *, {_top(cfg)} AS top
  FROM (SELECT DISTINCT accountSourceId, deviceSourceId, starttime, stream_type, sessionduration, bitrate,
               pluginSessionId, playbackId, clientGeneratedTimestamp FROM base)
), timeline AS (
  SELECT r.rid, r.accountSourceId, r.deviceSourceId, r.pluginSessionId, r.playbackId, r.stream_type, r.top,
         g.i AS col_rank, r.bitrate[g.i] AS b, r.clientGeneratedTimestamp[g.i] AS t,
         CASE WHEN r.top IS NULL THEN 0 ELSE r.clientGeneratedTimestamp[g.i] END AS ts_v
  FROM ptbtp_rows r,
       unnest(generate_series(1, greatest(len(r.bitrate), len(r.clientGeneratedTimestamp)))) AS g(i)
), seg AS (
  SELECT *, CASE WHEN col_rank = 1 OR ts_v - prev_value IS NULL THEN 0 ELSE ts_v - prev_value END AS diff,
         CASE WHEN next_bitrate = top THEN 1 ELSE 0 END AS btp_flag
  FROM (SELECT *, lag(ts_v) OVER w AS prev_value, lag(b) OVER w AS next_bitrate
        FROM timeline WINDOW w AS (PARTITION BY rid ORDER BY col_rank))
), last_ev AS (
  SELECT s.rid, s.b AS last_bitrate, s.ts_v AS last_timestamp
  FROM seg s JOIN (SELECT rid, max(col_rank) AS mr FROM seg GROUP BY rid) m
    ON s.rid = m.rid AND s.col_rank = m.mr
), mid AS (
  SELECT rid, CAST(sum(diff) AS BIGINT) AS time_below_top_profile FROM seg WHERE btp_flag = 0 GROUP BY rid
), parts AS (
  SELECT DISTINCT r.accountSourceId, r.deviceSourceId, r.pluginSessionId, r.playbackId, r.sessionduration,
         r.starttime, r.stream_type,
         CAST(CASE WHEN l.last_bitrate <> r.top THEN r.starttime + r.sessionduration - l.last_timestamp
              ELSE 0 END AS BIGINT) AS below_time_after_last_timestamp,
         m.time_below_top_profile
  FROM ptbtp_rows r JOIN last_ev l ON r.rid = l.rid JOIN mid m ON r.rid = m.rid
), ptbtp_pct AS (
  SELECT * FROM (
    SELECT {K4}, p.sessionduration, p.starttime, p.stream_type, s.stp_time,
           p.time_below_top_profile + p.below_time_after_last_timestamp AS time_below_top_profile,
           {sround("((p.time_below_top_profile + p.below_time_after_last_timestamp) / 1000) / ((p.sessionduration - s.stp_time) / 1000) * 100", 3)} AS percentage_below_top_profile
    FROM parts p JOIN (SELECT {K4}, stp_time FROM sst_detail) s USING ({K4}))
  WHERE percentage_below_top_profile >= 0 AND percentage_below_top_profile <= 100
), ptbtp_detail AS (
  SELECT {K4}, sessionduration, starttime, stream_type, time_below_top_profile, percentage_below_top_profile,
         CAST(CASE WHEN floor(percentage_below_top_profile) = 100 THEN 0
              ELSE sessionduration - abs(time_below_top_profile - stp_time) END AS BIGINT) AS time_at_top_profile
  FROM ptbtp_pct
), brs_detail AS (
  SELECT {K4}, sessionduration, CAST(len(bitrate) AS INTEGER) AS total_shifts
  FROM (SELECT DISTINCT {K4}, sessionduration, bitrate FROM base)
)"""]
    for name, (detail, value, avg, norm, bounds, nonneg) in KPI_SQL.items():
        b = getattr(cfg, bounds)
        parts.append(_session(f"{name}_session", detail, value, avg, nonneg))
        parts.append(f"""{name}_device AS (
  SELECT {K2}, {mean(avg)} AS {avg}, '{RUN_DATE}' AS event_date FROM {name}_session GROUP BY {K2})""")
        parts.append(f"""{name}_account AS (
  SELECT accountSourceId, {mean(avg)} AS {avg}, '{RUN_DATE}' AS event_date FROM {name}_device GROUP BY accountSourceId)""")
        for level in ("session", "device", "account"):
            parts.append(f"""{name}_{level}_norm AS (
  SELECT * REPLACE (CAST({_clip(avg, b)} AS DOUBLE) AS {avg}),
         (CAST({_clip(avg, b)} AS DOUBLE) - {b.lo!r}) / {(b.hi - b.lo)!r} AS {norm}
  FROM {name}_{level})""")
            parts.append(f"""{name}_{level}_values AS (
  SELECT *, (CAST({_clip(avg, b)} AS DOUBLE) - {b.lo!r}) / {(b.hi - b.lo)!r} AS {norm}
  FROM {name}_{level})""")
    parts.append(_combined_sql(cfg))
    return ",\n".join(parts)


def _combined_sql(cfg: QoeConfig) -> str:
    w = (cfg.weight_ptbtp, cfg.weight_tttp, cfg.weight_brs, cfg.weight_sst)
    score = (f"100 * (1 - ({w[0]!r}::DOUBLE * {mean('normalized_weighted_average_ptbtp')}"
             f" + {w[1]!r}::DOUBLE * {mean('normalized_tttp')}"
             f" + {w[2]!r}::DOUBLE * {mean('normalized_weighted_average_bitrate')}"
             f" + {w[3]!r}::DOUBLE * {mean('normalized_stp')}))")
    z = "coalesce({0}, 0) AS {0}".format
    session_cols = ", ".join([
        K4, "tttp", "az_insert_ts", z("weighted_average_tttp"), z("normalized_tttp"), z("sessionduration"),
        "stream_type", z("time_below_top_profile"), z("time_at_top_profile"), z("percentage_below_top_profile"),
        z("weighted_average_ptbtp"), z("normalized_weighted_average_ptbtp"), z("total_shifts"),
        z("weighted_average_bitrate"), z("normalized_weighted_average_bitrate"), z("starttime"), z("stp_time"),
        z("percentage_of_stp_time"), z("weighted_average_stp"), z("normalized_stp"),
    ])
    level_cols = lambda keys: ", ".join([
        keys, z("weighted_average_tttp"), z("normalized_tttp"), z("weighted_average_ptbtp"),
        z("normalized_weighted_average_ptbtp"), z("weighted_average_stp"), z("normalized_stp"),
        z("weighted_average_bitrate"), z("normalized_weighted_average_bitrate"),
    ])
    return f"""t_side AS (
  SELECT * FROM (SELECT DISTINCT {K4}, tttp, az_insert_ts FROM tttp_detail)
  JOIN (SELECT {K3}, weighted_average_tttp, normalized_tttp FROM tttp_session_norm) USING ({K3})
), p_side AS (
  SELECT * FROM (SELECT DISTINCT {K4}, sessionduration, stream_type, time_below_top_profile, time_at_top_profile,
                        percentage_below_top_profile FROM ptbtp_detail)
  JOIN (SELECT {K3}, weighted_average_ptbtp, normalized_weighted_average_ptbtp FROM ptbtp_session_norm) USING ({K3})
), b_side AS (
  SELECT * FROM (SELECT DISTINCT {K4}, total_shifts FROM brs_detail)
  JOIN (SELECT {K3}, weighted_average_bitrate, normalized_weighted_average_bitrate FROM brs_session_norm) USING ({K3})
), s_side AS (
  SELECT * FROM (SELECT DISTINCT {K4}, starttime, stp_time, percentage_of_stp_time FROM sst_detail)
  JOIN (SELECT {K3}, weighted_average_stp, normalized_stp FROM stp_session_norm) USING ({K3})
), combined_session AS (
  SELECT DISTINCT {session_cols}, '{RUN_DATE}' AS event_date
  FROM t_side FULL JOIN p_side USING ({K4}) FULL JOIN b_side USING ({K4}) FULL JOIN s_side USING ({K4})
  WHERE accountSourceId IS NOT NULL AND stream_type IS NOT NULL
), combined_device AS (
  SELECT DISTINCT {level_cols(K2)}, '{RUN_DATE}' AS event_date
  FROM tttp_device_values FULL JOIN ptbtp_device_values USING ({K2}, event_date)
       FULL JOIN stp_device_values USING ({K2}, event_date) FULL JOIN brs_device_values USING ({K2}, event_date)
  WHERE accountSourceId IS NOT NULL
), combined_account AS (
  SELECT DISTINCT {level_cols("accountSourceId")}, '{RUN_DATE}' AS event_date
  FROM tttp_account_values FULL JOIN ptbtp_account_values USING (accountSourceId, event_date)
       FULL JOIN stp_account_values USING (accountSourceId, event_date)
       FULL JOIN brs_account_values USING (accountSourceId, event_date)
  WHERE accountSourceId IS NOT NULL
), score_session AS (
  SELECT {K3}, {score} AS session_score FROM combined_session GROUP BY {K3}
), score_device AS (
  SELECT {K2}, {score} AS device_score FROM combined_device GROUP BY {K2}
), score_account AS (
  SELECT accountSourceId, {score} AS account_score FROM combined_account GROUP BY accountSourceId
), score_session_detail AS (
  SELECT * FROM combined_session JOIN score_session USING ({K3})
), score_device_detail AS (
  SELECT * FROM combined_device JOIN score_device USING ({K2})
), score_account_detail AS (
  SELECT * FROM combined_account JOIN score_account USING (accountSourceId)
), wifi_all AS (
  SELECT HHID, GW_MAC_ADDRESS, DEVICE_MAC, DEVICE_VENDOR, DEVICE_TAG, LAST_24H_MEDIAN_DEVICE_RSSI,
         CURRENT_HR_DEVICE_RSSI, CURRENT_HR_DEVICE_SNR, WIFI_HAPPINESS_INDEX, CURRENT_HR_DEVICE_RX,
         CURRENT_HR_DEVICE_TX, CURRENT_HR_DEVICE_RET, received_date, DATE_TIME,
         CAST(hour(DATE_TIME) AS INTEGER) AS hour,
         lpad(upper(hex(CAST('0x' || DEVICE_MAC AS BIGINT) - {cfg.wifi_mac_offset})), 12, '0') AS deviceSourceId
  FROM wifi_raw
  WHERE {" OR ".join(f"DEVICE_VENDOR LIKE '{p}%'" for p in cfg.wifi_vendor_prefixes)}
), wifi_day AS (
  SELECT * FROM wifi_all WHERE received_date = DATE '{WIFI_DAY}'
), wifi_max AS (
  SELECT HHID AS accountSourceId, deviceSourceId,
         max(LAST_24H_MEDIAN_DEVICE_RSSI) AS LAST_24H_MEDIAN_DEVICE_RSSI, max(CURRENT_HR_DEVICE_RSSI) AS CURRENT_HR_DEVICE_RSSI,
         max(CURRENT_HR_DEVICE_SNR) AS CURRENT_HR_DEVICE_SNR, max(CURRENT_HR_DEVICE_RX) AS CURRENT_HR_DEVICE_RX,
         max(CURRENT_HR_DEVICE_TX) AS CURRENT_HR_DEVICE_TX, max(CURRENT_HR_DEVICE_RET) AS CURRENT_HR_DEVICE_RET,
         max(WIFI_HAPPINESS_INDEX) AS WIFI_HAPPINESS_INDEX, max(DEVICE_VENDOR) AS DEVICE_VENDOR,
         max(DEVICE_TAG) AS DEVICE_TAG, max(received_date) AS received_date, max(DATE_TIME) AS DATE_TIME
  FROM wifi_day GROUP BY HHID, deviceSourceId
)"""


def with_stages(select: str, cfg: QoeConfig = DEFAULT) -> str:
    return f"WITH {FIXTURE_SQL},\n{stage_sql(cfg)}\n{select}"


def on_day(select: str, day: str, cfg: QoeConfig = DEFAULT) -> str:
    """``with_stages`` over one received day of the feed, stamped with it."""
    fixtures = FIXTURE_SQL.replace("playback_raw AS (", "playback_all AS (")
    sliced = f"playback_raw AS (SELECT * FROM playback_all WHERE received_date = DATE '{day}')"
    return f"WITH {fixtures}, {sliced},\n{stage_sql(cfg)}\n{select}".replace(f"'{RUN_DATE}'", f"'{day}'")


def with_fixtures(select: str) -> str:
    return f"WITH {FIXTURE_SQL}\n{select}"


# --- output formatting (mirrors ``catalog.finish``) -------------------------------------------

def r6(x: str) -> str:
    """Same rule as ``catalog.round6``: the shortest decimal text of the double taken
    half-up to 12 places, then half-up to 6."""
    x = f"CAST({x} AS DOUBLE)"
    exact = f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12)), 6) AS DOUBLE)"
    return f"CASE WHEN abs({x}) < 1e12 THEN {exact} ELSE {x} END"


def out(spec: str) -> str:
    """``name:kind`` list -> select list. kinds: d double, t timestamp, D date, a array, else as is."""
    cols = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        q = f'"{name}"'
        if kind == "d":
            cols.append(f"{r6(q)} AS {q}")
        elif kind == "t":
            cols.append(f"strftime({q}, '%Y-%m-%d %H:%M:%S') AS {q}")
        elif kind == "D":
            cols.append(f"strftime({q}, '%Y-%m-%d') AS {q}")
        elif kind == "a":
            cols.append(f"array_to_string(list_transform({q}, lambda x: coalesce(CAST(x AS VARCHAR), 'NULL')), ',') AS {q}")
        elif kind:
            cols.append(f"CAST({q} AS {kind}) AS {q}")
        else:
            cols.append(q)
    return ", ".join(cols)


K4S = "accountSourceId deviceSourceId pluginSessionId playbackId"
K3S = "accountSourceId deviceSourceId pluginSessionId"
FLAT13 = ("gracenoteId accountSourceId deviceSourceId starttime sessionduration bitrate:a pluginSessionId playbackId "
          "ff_shifts_present:INTEGER clientGeneratedTimestamp_flattened clientGeneratedTimestamp:a bitrate_flattened "
          "az_insert_ts:t")
BASE15 = FLAT13 + " ts_name stream_type"
AVG = {"tttp": "weighted_average_tttp", "sst": "weighted_average_stp", "ptbtp": "weighted_average_ptbtp",
       "brs": "weighted_average_bitrate"}
NORM = {"tttp": "normalized_tttp", "sst": "normalized_stp", "ptbtp": "normalized_weighted_average_ptbtp",
        "brs": "normalized_weighted_average_bitrate"}
INTERNAL = {"tttp": "tttp", "sst": "stp", "ptbtp": "ptbtp", "brs": "brs"}
SESSION_DETAIL = (f"{K4S} tttp:d az_insert_ts:t weighted_average_tttp:d normalized_tttp:d sessionduration stream_type "
                  "time_below_top_profile time_at_top_profile percentage_below_top_profile:d weighted_average_ptbtp:d "
                  "normalized_weighted_average_ptbtp:d total_shifts weighted_average_bitrate:d "
                  "normalized_weighted_average_bitrate:d starttime stp_time percentage_of_stp_time:d "
                  "weighted_average_stp:d normalized_stp:d event_date")
LEVEL_DETAIL = ("weighted_average_tttp:d normalized_tttp:d weighted_average_ptbtp:d "
                "normalized_weighted_average_ptbtp:d weighted_average_stp:d normalized_stp:d "
                "weighted_average_bitrate:d normalized_weighted_average_bitrate:d event_date")
RAW_FLAT = ("accountSourceId deviceSourceId bitrate:a eventtype starttime applicationname completionstatus assetclass "
            "sessionduration pluginSessionId playbackId mediaOpenLatency bufferunderflow buffercount bufferratio:d "
            "title clientGeneratedTimestamp:a received_date:D az_insert_ts:t")
WIFI_SLICE = ("HHID GW_MAC_ADDRESS DEVICE_MAC DEVICE_VENDOR DEVICE_TAG LAST_24H_MEDIAN_DEVICE_RSSI:d "
              "CURRENT_HR_DEVICE_RSSI:d CURRENT_HR_DEVICE_SNR CURRENT_HR_DEVICE_RX CURRENT_HR_DEVICE_TX "
              "CURRENT_HR_DEVICE_RET WIFI_HAPPINESS_INDEX received_date:D DATE_TIME:t hour deviceSourceId")
SESSION_HOUR = ("deviceSourceId pluginSessionId playbackId tttp:d az_insert_ts:t sessionduration stream_type "
                "time_below_top_profile time_at_top_profile percentage_below_top_profile:d total_shifts starttime "
                "stp_time percentage_of_stp_time:d DEVICE_VENDOR DEVICE_TAG LAST_24H_MEDIAN_DEVICE_RSSI:d "
                "CURRENT_HR_DEVICE_RSSI:d CURRENT_HR_DEVICE_SNR CURRENT_HR_DEVICE_RX CURRENT_HR_DEVICE_TX "
                "CURRENT_HR_DEVICE_RET WIFI_HAPPINESS_INDEX hour session_score:d received_date:D")
DEVICE_WIFI = ("accountSourceId deviceSourceId weighted_average_tttp:d weighted_average_bitrate:d "
               "weighted_average_ptbtp:d weighted_average_stp:d DEVICE_VENDOR DEVICE_TAG LAST_24H_MEDIAN_DEVICE_RSSI:d "
               "CURRENT_HR_DEVICE_RSSI:d CURRENT_HR_DEVICE_SNR CURRENT_HR_DEVICE_RX CURRENT_HR_DEVICE_TX "
               "CURRENT_HR_DEVICE_RET WIFI_HAPPINESS_INDEX device_score:d received_date:D")


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    S = with_stages
    F_ = with_fixtures
    q["scan_project"] = F_(f"SELECT {out(K4S + ' assetclass title eventtype sessionduration')} FROM playback_raw")
    q["scan_distinct"] = F_(f"SELECT DISTINCT {out('accountSourceId assetclass title')} FROM playback_raw")
    q["daily_slice"] = F_(f"SELECT {out(RAW_FLAT)} FROM playback_raw WHERE received_date = DATE '{RUN_DATE}'")
    q["sink_replace"] = S(f"SELECT {out(K4S + ' sessionduration total_shifts:INTEGER')} FROM brs_detail")
    q["sink_replace_named"] = q["sink_replace"]
    for level, cols in (("session", SESSION_DETAIL), ("device", f"accountSourceId deviceSourceId {LEVEL_DETAIL}"),
                        ("account", f"accountSourceId {LEVEL_DETAIL}")):
        q[f"sink_history_{level}"] = " UNION ALL ".join(
            f"SELECT * FROM ({on_day(f'SELECT {out(f'{cols} {level}_score:d')} FROM score_{level}_detail', day)})" for day in HISTORY_DAYS)
    q["base_table_day"] = on_day(f"SELECT {out(BASE15)} FROM base", HISTORY_DAYS[0])
    q["kpi_startup_dedupe"] = S(
        f"SELECT {out(K4S + ' starttime sessionduration stp_bitrate stp_clientgeneratedtimestamp stp_time percentage_of_stp_time:d')} "
        "FROM (SELECT DISTINCT ON (accountSourceId, deviceSourceId, pluginSessionId, playbackId, starttime, sessionduration, bitrate, clientGeneratedTimestamp) * "
        "      FROM base) b, LATERAL (SELECT bitrate[1] AS stp_bitrate, clientGeneratedTimestamp[1] AS stp_clientgeneratedtimestamp, "
        "      clientGeneratedTimestamp[1] - starttime AS stp_time, (clientGeneratedTimestamp[1] - starttime) / sessionduration AS percentage_of_stp_time) "
        "WHERE stp_time >= 0 AND percentage_of_stp_time >= 0")
    q["prep_channel_id"] = F_(
        f"SELECT {out('playbackId title gracenoteId')} FROM "
        "(SELECT playbackId, title, string_split(title, ':')[2] AS gracenoteId FROM playback_raw)")
    q["prep_eligible"] = F_(
        f"SELECT {out(K4S + ' sessionduration completionstatus')} FROM playback_raw "
        "WHERE eventtype = 'End' AND applicationname = 'STB-XI6' AND assetclass = 'Linear' "
        "AND sessionduration BETWEEN 300000 AND 7200000 AND mediaOpenLatency IS NOT NULL "
        "AND buffercount IS NOT NULL AND bufferratio IS NOT NULL AND completionstatus <> 'MediaFailed' "
        "AND bitrate IS NOT NULL")
    q["prep_playstate"] = F_(
        f"SELECT {out('playbackId eventtype')} FROM playback_raw r WHERE EXISTS "
        "(SELECT 1 FROM unnest(r.playstateChanged) AS p(s) WHERE p.s.value IN ('initializing', 'initialized'))")
    q["prep_events_after_start"] = F_(
        f"SELECT {out('playbackId starttime clientGeneratedTimestamp_flattened')} FROM "
        "(SELECT r.playbackId, r.starttime, t.x AS clientGeneratedTimestamp_flattened "
        " FROM playback_raw r, unnest(list_distinct(r.clientGeneratedTimestamp)) AS t(x) WHERE t.x > r.starttime)")
    q["prep_fast_forward"] = F_(
        f"SELECT DISTINCT {out('playbackId bitrate_flattened ff_shifts_present:INTEGER')} FROM "
        "(SELECT r.playbackId, b.x AS bitrate_flattened, 0 AS ff_shifts_present "
        " FROM playback_raw r, unnest(r.bitrate) AS b(x) WHERE b.x IS NULL OR b.x <> 313200)")
    q["prep_flatten"] = S(f"SELECT {out(FLAT13)} FROM prepped")
    q["prep_flatten_stored"] = q["prep_flatten"]
    q["prep_anti_test_devices"] = S(f"SELECT {out(FLAT13)} FROM no_test")
    q["prep_stream_type"] = S(f"SELECT {out('gracenoteId ts_name stream_type')} FROM chan")
    q["prep_channel_join"] = S(
        f"SELECT {out(BASE15)} FROM (SELECT p.*, c.ts_name, c.stream_type "
        "FROM prepped p JOIN chan c ON p.gracenoteId = c.gracenoteId)")
    q["base_table"] = S(f"SELECT {out(BASE15)} FROM base")
    q["kpi_time_to_top"] = S(
        f"SELECT {out(K4S + ' starttime sessionduration stream_type tttp:d az_insert_ts:t')} FROM tttp_detail")
    q["kpi_startup"] = S(
        f"SELECT {out(K4S + ' starttime sessionduration stp_bitrate stp_clientgeneratedtimestamp stp_time percentage_of_stp_time:d')} "
        "FROM sst_detail")
    q["kpi_timeline"] = S(
        f"SELECT {out(K4S + ' stream_type col_rank:INTEGER bitrate top_profile_timestamp:BIGINT below_top_profile_timestamp:BIGINT timestamp:BIGINT')} FROM "
        "(SELECT *, b AS bitrate, CASE WHEN b = top THEN t ELSE 0 END AS top_profile_timestamp, "
        " CASE WHEN NOT (b = top) THEN t ELSE 0 END AS below_top_profile_timestamp, ts_v AS timestamp FROM timeline)")
    q["kpi_event_rank"] = S(
        f"SELECT {out(K4S + ' stream_type col_rank:INTEGER bitrate')} FROM (SELECT *, b AS bitrate FROM timeline)")
    q["kpi_segment_diff"] = S(
        f"SELECT {out(K4S + ' stream_type col_rank:INTEGER diff:BIGINT btp_flag:INTEGER')} FROM seg")
    q["kpi_last_event"] = S(
        f"SELECT {out(K4S + ' stream_type last_bitrate last_timestamp:BIGINT')} FROM "
        "(SELECT r.*, l.last_bitrate, l.last_timestamp FROM ptbtp_rows r JOIN last_ev l ON r.rid = l.rid)")
    q["kpi_tail_below"] = S(
        f"SELECT {out(K4S + ' stream_type sessionduration starttime below_time_after_last_timestamp')} FROM parts")
    q["kpi_time_below"] = S(f"SELECT {out(K4S + ' stream_type time_below_top_profile')} FROM parts")
    q["kpi_pct_below_top"] = S(
        f"SELECT {out(K4S + ' sessionduration starttime stream_type time_below_top_profile percentage_below_top_profile:d time_at_top_profile')} "
        "FROM ptbtp_detail")
    q["kpi_time_at_top"] = S(
        f"SELECT DISTINCT {out(K4S + ' stream_type percentage_below_top_profile:d time_at_top_profile')} FROM ptbtp_detail")
    q["kpi_bitrate_shifts"] = S(f"SELECT {out(K4S + ' sessionduration total_shifts')} FROM brs_detail")
    for key, name in INTERNAL.items():
        avg = AVG[key]
        q[f"session_{key}"] = S(f"SELECT {out(K3S + f' {avg}:d event_date')} FROM {name}_session")
        q[f"device_{key}"] = S(f"SELECT {out(f'accountSourceId deviceSourceId {avg}:d event_date')} FROM {name}_device")
        q[f"account_{key}"] = S(f"SELECT {out(f'accountSourceId {avg}:d event_date')} FROM {name}_account")
        for level, keys in (("session", K3S), ("device", "accountSourceId deviceSourceId"), ("account", "accountSourceId")):
            q["normalize_" + (key if level == "session" else f"{level}_{key}")] = with_stages(
                f"SELECT {out(f'{keys} {avg}:d event_date {NORM[key]}:d')} FROM {name}_{level}_norm", FIXTURE_TUNING)
    q["combined_session"] = S(f"SELECT {out(SESSION_DETAIL)} FROM combined_session")
    q["combined_device"] = S(f"SELECT {out('accountSourceId deviceSourceId ' + LEVEL_DETAIL)} FROM combined_device")
    q["combined_account"] = S(f"SELECT {out('accountSourceId ' + LEVEL_DETAIL)} FROM combined_account")
    q["score_session"] = S(f"SELECT {out(K3S + ' session_score:d')} FROM score_session")
    q["score_device"] = S(f"SELECT {out('accountSourceId deviceSourceId device_score:d')} FROM score_device")
    q["score_account"] = S(f"SELECT {out('accountSourceId account_score:d')} FROM score_account")
    for level, keys in (("session", K3S), ("device", "accountSourceId deviceSourceId"), ("account", "accountSourceId")):
        q[f"score_{level}_tuned"] = with_stages(f"SELECT {out(f'{keys} {level}_score:d')} FROM score_{level}", FIXTURE_TUNING)
    q["score_session_detail"] = S(f"SELECT {out(SESSION_DETAIL + ' session_score:d')} FROM score_session_detail")
    q["score_device_detail"] = S(
        f"SELECT {out('accountSourceId deviceSourceId ' + LEVEL_DETAIL + ' device_score:d')} FROM score_device_detail")
    q["score_account_detail"] = S(
        f"SELECT {out('accountSourceId ' + LEVEL_DETAIL + ' account_score:d')} FROM score_account_detail")
    q["wifi_slice"] = S(f"SELECT {out(WIFI_SLICE)} FROM wifi_day")
    q["wifi_mac_align"] = F_(
        f"SELECT DISTINCT {out('DEVICE_MAC deviceSourceId')} FROM (SELECT DEVICE_MAC, "
        "lpad(upper(hex(CAST('0x' || DEVICE_MAC AS BIGINT) - 2)), 12, '0') AS deviceSourceId FROM wifi_raw)")
    q["wifi_session_hour"] = S(
        f"SELECT {out(SESSION_HOUR)} FROM (SELECT DISTINCT * REPLACE (replace(deviceSourceId, ':', '') AS deviceSourceId), "
        "CAST(hour(az_insert_ts) AS INTEGER) AS hour FROM score_session_detail) l "
        "JOIN wifi_day w USING (deviceSourceId, hour)")
    q["wifi_session_hour_account"] = S(
        f"SELECT {out(SESSION_HOUR + ' accountSourceId')} FROM (SELECT DISTINCT * REPLACE (replace(deviceSourceId, ':', '') AS deviceSourceId), "
        "CAST(hour(az_insert_ts) AS INTEGER) AS hour FROM score_session_detail) l "
        "JOIN (SELECT * RENAME (HHID AS accountSourceId) FROM wifi_day) w USING (deviceSourceId, hour, accountSourceId)")
    q["wifi_device_max"] = S(
        "SELECT " + out("accountSourceId deviceSourceId LAST_24H_MEDIAN_DEVICE_RSSI:d CURRENT_HR_DEVICE_RSSI:d "
                        "CURRENT_HR_DEVICE_SNR CURRENT_HR_DEVICE_RX CURRENT_HR_DEVICE_TX CURRENT_HR_DEVICE_RET "
                        "WIFI_HAPPINESS_INDEX DEVICE_VENDOR DEVICE_TAG received_date:D DATE_TIME:t") + " FROM wifi_max")
    q["wifi_device"] = S(
        f"SELECT DISTINCT {out(DEVICE_WIFI)} FROM "
        "(SELECT DISTINCT * REPLACE (replace(deviceSourceId, ':', '') AS deviceSourceId) FROM score_device_detail) l "
        "JOIN (SELECT * EXCLUDE (accountSourceId) FROM wifi_max) r USING (deviceSourceId)")
    # trends
    days = "(SELECT user_id, CAST(ts AS DATE) AS polling_date, value FROM events)"
    q["activity_span"] = (
        f"SELECT {out('user_id max_polling_date:D min_polling_date:D active_days:INTEGER')} FROM "
        f"(SELECT user_id, max(polling_date) AS max_polling_date, min(polling_date) AS min_polling_date, "
        f" datediff('day', min(polling_date), max(polling_date)) AS active_days FROM {days} GROUP BY user_id)")
    q["minmax_scale"] = ("SELECT p_partkey, " + r6("p_retailprice") + " AS p_retailprice, "
                         + r6("(CAST(p_retailprice AS DOUBLE) - 900.0) / (2000.0 - 900.0)") + " AS n_ttp FROM part")
    chain = ("(SELECT o_custkey AS custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o {j} "
             "(SELECT user_id AS custkey, count(*) AS n_events FROM events GROUP BY user_id) e USING (custkey) {j} "
             "(SELECT c_custkey AS custkey, c_acctbal FROM customer) c USING (custkey)")
    q["join_chain_inner"] = f"SELECT custkey, n_orders, n_events, {r6('c_acctbal')} AS c_acctbal FROM {chain.format(j='JOIN')}"
    q["join_chain_full"] = f"SELECT custkey, n_orders, n_events, {r6('c_acctbal')} AS c_acctbal FROM {chain.format(j='FULL JOIN')}"
    q["moving_avg_window"] = (
        f"SELECT event_id, user_id, {r6('value')} AS value, "
        + r6("coalesce(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND "
             "CURRENT ROW), 0)") + " AS avg_value_last10 FROM events")
    user_days = f"(SELECT user_id, polling_date, avg(value) AS day_value FROM {days} GROUP BY user_id, polling_date)"
    for key, frame in (("moving_avg_back", "INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"),
                       ("moving_avg_ahead", "INTERVAL 1 DAY FOLLOWING AND INTERVAL 7 DAY FOLLOWING")):
        out_col = "avg_back_7d" if key == "moving_avg_back" else "avg_ahead_7d"
        q[key] = (
            f"SELECT user_id, strftime(polling_date, '%Y-%m-%d') AS polling_date, {r6('day_value')} AS day_value, "
            + r6(f"coalesce(avg(day_value) OVER (PARTITION BY user_id ORDER BY polling_date RANGE BETWEEN {frame}), 0)")
            + f" AS {out_col} FROM {user_days}")
    q["count_in_range"] = ('SELECT l_returnflag, count(*) AS "count" FROM lineitem '
                           "WHERE l_quantity <= 20 AND l_quantity >= 10 GROUP BY l_returnflag")
    q["count_at_least"] = 'SELECT l_returnflag, count(*) AS "count" FROM lineitem WHERE l_quantity >= 10 GROUP BY l_returnflag'
    q["count_at_most"] = 'SELECT l_returnflag, count(*) AS "count" FROM lineitem WHERE l_quantity <= 20 GROUP BY l_returnflag'
    q["peak_usage"] = (f"SELECT l_suppkey, {r6('max(l_quantity)')} AS max_l_quantity, "
                       f"{r6('max(l_extendedprice)')} AS max_l_extendedprice FROM lineitem GROUP BY l_suppkey")
    q["presence_ratio"] = (
        f"SELECT user_id, days_present, {r6('days_present / 11')} AS presence_pct FROM "
        f"(SELECT user_id, count(DISTINCT polling_date) AS days_present FROM {days} "
        "WHERE polling_date >= DATE '2024-01-10' AND polling_date <= DATE '2024-01-20' GROUP BY user_id)")
    q["sink_history_named"] = q["sink_history_device"]
    return q
