"""General trend / activity operators over keyed, dated frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from qoeflow.operators.joins import join_chain
from qoeflow.session import handoff

DAY_SECONDS = 86400


def activity_span(frame: DataFrame, key: str | list[str], date_col: str, out: str) -> DataFrame:
    """TRD1: first and last date per key and the days between them."""
    return frame.groupBy(key).agg(
        F.max(date_col).alias("max_polling_date"), F.min(date_col).alias("min_polling_date")
    ).withColumn(out, F.datediff("max_polling_date", "min_polling_date"))


def minmax_scale(frame: DataFrame, column: str, upper: float, lower: float, out: str = "n_ttp") -> DataFrame:
    """TRD2: ``(x - lower) / (upper - lower)`` without clipping."""
    lo, hi = float(lower), float(upper)
    return frame.withColumn(out, (F.col(column).cast("double") - F.lit(lo)) / F.lit(hi - lo))


def join_frames(frames: list[DataFrame], how: str, key) -> DataFrame:
    """TRD3: left-deep chain of one join type over two to five (or more) frames."""
    return join_chain(frames, how, key)


def moving_avg(frame: DataFrame, window: WindowSpec, column: str, out: str) -> DataFrame:
    """TRD4: mean of ``column`` over a caller-given window; no rows in frame -> 0."""
    return frame.withColumn(out, F.avg(column).over(window)).fillna(0, subset=[out])


def moving_avg_last(frame: DataFrame, key: str, order_col: str, column: str, out: str, rows: int,
                    chunk: Column) -> DataFrame:
    """TRD4 over the last ``rows`` rows of a key, also for a key that holds a large part of all rows.

    ``chunk`` cuts a key's rows to ranges of the order column (e.g. ``order_col div 4096``), and each
    range is a window of its own. What a range needs of the ones before it, the last ``rows - 1`` rows,
    is found among the ranges' own last rows only, and is carried over.
    """
    back = rows - 1
    cols = frame.columns
    cut = frame.select("*", chunk.alias("_chunk"))
    by_range = Window.partitionBy(key, "_chunk")
    ends = cut.select(key, "_chunk", order_col, column,
                      F.row_number().over(by_range.orderBy(F.col(order_col).desc())).alias("_last"),
                      F.row_number().over(by_range.orderBy(order_col)).alias("_first")).where(
        (F.col("_last") <= back) | (F.col("_first") == 1))
    # A range's first row marks where it begins; where it is none of the last ones it is no one's carry.
    entry = F.when(F.col("_last") <= back, F.struct(order_col, column))
    before = F.collect_list(entry).over(
        Window.partitionBy(key).orderBy(order_col).rowsBetween(-2 * back - 1, -1))
    carried = (ends.select(key, "_chunk", "_first", before.alias("_before")).where("_first = 1")
               .select(key, "_chunk", F.explode(F.slice("_before", F.greatest(F.size("_before") - back + 1, F.lit(1)), back)).alias("_row"))
               .select(key, "_chunk", F.col(f"_row.{order_col}").alias(order_col), F.col(f"_row.{column}").alias(column)))
    both = cut.withColumn("_own", F.lit(True)).unionByName(carried.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    window = by_range.orderBy(order_col).rowsBetween(-back, 0)
    mean = F.coalesce(F.avg(column).over(window), F.lit(0.0))
    return both.withColumn(out, mean).where("_own").select(*cols, out)


def moving_avg_rows(frame: DataFrame, key: str, order_col: str, column: str, out: str, rows: int) -> DataFrame:
    """TRD4 over the last ``rows`` rows of a key, cut to ranges by rank.

    The rows are range-sorted by key and order column, and each partition of that sort is a range, whatever the
    gaps between the order values: a range has about as many rows as any other, a key with a large part of all
    rows spans many, and there are as many as partitions, not rows. Equal order values share a range. The
    ranges are a hand-off table, for they are read twice.
    """
    ranges = frame.repartitionByRange(F.col(key), F.col(order_col)).withColumn("_range", F.spark_partition_id())
    laid = handoff(ranges, "ranges")
    return moving_avg_last(laid, key, order_col, column, out, rows, F.col("_range")).drop("_range")


def day_offsets(from_days: int, to_days: int, flag: str) -> tuple[int, int]:
    """Ends of the day range in seconds: ``minus`` looks back ``[-from, -to]`` days, ``plus`` ahead ``[+from, +to]``."""
    if flag == "minus":
        return -from_days * DAY_SECONDS, -to_days * DAY_SECONDS
    if flag == "plus":
        return from_days * DAY_SECONDS, to_days * DAY_SECONDS
    raise ValueError(f"flag must be 'minus' or 'plus', got {flag!r}")


def order_seconds(order_col: str, is_date: bool) -> Column:
    """Dates by their day number (no time-zone or daylight-saving shift), timestamps by epoch seconds."""
    if is_date:
        return F.unix_date(F.col(order_col)).cast("bigint") * DAY_SECONDS
    return F.unix_seconds(F.col(order_col).cast("timestamp"))


def day_range_window(key: str | list[str], order_col: str, from_days: int, to_days: int, flag: str,
                     is_date: bool = False) -> WindowSpec:
    """The plain range frame of the same days, over all rows of a key."""
    lo, hi = day_offsets(from_days, to_days, flag)
    return Window.partitionBy(key).orderBy(order_seconds(order_col, is_date)).rangeBetween(lo, hi)


def moving_avg_days(frame: DataFrame, columns: list[str], order_col: str, key: str | list[str],
                    outs: list[str], from_days: int, to_days: int, flag: str, bucket_days: int | None = None) -> DataFrame:
    """TRD5: look-back / look-ahead mean over a day range for several columns at once.

    A key's rows are cut to buckets of ``bucket_days`` days (four times the reach where it isn't given), and a
    bucket is a window of its own. A row stands in its own bucket and, as a copy that gives no result, in those
    whose rows look at it: only rows near a border are copied, and a key that holds a large part of all rows is
    spread over as many tasks as it has buckets. Rows without a date see the other rows without one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    is_date = isinstance(frame.schema[order_col].dataType, DateType)
    lo, hi = day_offsets(from_days, to_days, flag)
    reach = max(abs(lo), abs(hi), DAY_SECONDS) // DAY_SECONDS
    width = F.lit((bucket_days or 4 * reach) * DAY_SECONDS)
    at = order_seconds(order_col, is_date)
    bucket = lambda t: F.floor(t / width).cast("bigint")
    seen_from = F.sequence(bucket(at - F.lit(hi)), bucket(at - F.lit(lo)))
    places = F.coalesce(F.array_union(F.array(bucket(at)), seen_from), F.array(F.lit(None).cast("bigint")))
    cut = frame.select("*", bucket(at).alias("_home"), F.explode(places).alias("_bucket"))
    w = Window.partitionBy(*keys, "_bucket").orderBy(at).rangeBetween(lo, hi)
    means = [F.coalesce(F.avg(c).over(w), F.lit(0.0)).alias(o) for c, o in zip(columns, outs)]
    return cut.select("*", *means).where(F.col("_bucket").eqNullSafe(F.col("_home"))).drop("_bucket", "_home")


def count_by_range(frame: DataFrame, column: str, group: str | list[str], upper, lower) -> DataFrame:
    """TRD6: rows with ``lower <= column <= upper`` per group; ``None`` (or ``"NULL"``)
    leaves that side open."""
    open_ = (None, "NULL")
    c = F.col(column)
    if upper in open_ and lower in open_:
        cond = F.lit(True)
    elif upper in open_:
        cond = c >= lower
    elif lower in open_:
        cond = c <= upper
    else:
        cond = (c <= upper) & (c >= lower)
    return frame.where(cond).groupBy(group).count()


def peak_usage(frame: DataFrame, columns: list[str], group: str | list[str]) -> DataFrame:
    """TRD7: maximum of two columns per group (one aggregate)."""
    return frame.groupBy(group).agg(*[F.max(c).alias(f"max_{c}") for c in columns])


def presence_ratio(frame: DataFrame, key: str | list[str], start_col: str, count_col: str, pct_col: str,
                   span: int, date_col: str = "polling_date", end_col: str = "current_date") -> DataFrame:
    """TRD8: days present in ``[start_col, end_col]`` per key and their share of ``span``, most present first
    (ties by key).

    Days are set as bits of one word per key and 63 days, so that what is shuffled is a word, not a row for
    each day, and repeated days cost nothing. Other types than dates are counted as distinct values.
    """
    keys = [key] if isinstance(key, str) else list(key)
    d = F.col(date_col)
    inside = frame.where((d >= F.col(start_col)) & (d <= F.col(end_col)))
    if isinstance(frame.schema[date_col].dataType, DateType):
        day = F.unix_date(d).cast("bigint")
        words = inside.groupBy(*keys, F.floor(day / 63).alias("_word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(63)).cast("int"))).alias("_days"))
        counted = words.groupBy(*keys).agg(F.sum(F.bit_count("_days")).alias(count_col))
    else:
        counted = inside.groupBy(*keys).agg(F.count_distinct(date_col).alias(count_col))
    return counted.withColumn(pct_col, F.col(count_col) / F.lit(span)).orderBy(F.col(count_col).desc(), *keys)
