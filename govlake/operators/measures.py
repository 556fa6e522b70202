"""Measure families (A1-A40) as grouped DataFrame aggregations.

A measure is (fact, aggregate, filter, group-by).  Every family takes the
group-by columns as an argument, so the same code answers a total, a
per-capacity or a per-day question.  Aggregations use Spark's two-phase
(partial + final) hash aggregate: at most one row per group per partition
crosses the shuffle, so a hot group does not overload one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blank import blank0, dcount_blank, ddivide
from ..functions.scalar import SIZE_UNITS, TIME_UNITS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_date(d) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)[:10]).cast("date")


def measure(df: DataFrame, aggs: dict[str, Column] | Column, where: Column | None = None,
            by: list | None = None) -> DataFrame:
    """Generic measure: filter, group, aggregate.  ``aggs`` maps output name
    to an aggregate column (or is one column, named ``value``)."""
    if where is not None:
        df = df.filter(where)
    if isinstance(aggs, Column):
        aggs = {"value": aggs}
    cols = [a.alias(n) for n, a in aggs.items()]
    return df.groupBy(*(by or [])).agg(*cols)


# A1 ---------------------------------------------------------------------------
def live_count(df: DataFrame, by: list | None = None, deleted_col: str = "is_deleted",
               name: str = "live_count") -> DataFrame:
    """Rows not flagged deleted (null counts as live)."""
    cond = ~F.coalesce(F.col(deleted_col), F.lit(False)) if deleted_col in df.columns else F.lit(True)
    return measure(df, {name: F.count(F.lit(1))}, cond, by)


# A2 ---------------------------------------------------------------------------
def count_by_type(df: DataFrame, type_col: str, by: list | None = None, types: list[str] | None = None,
                  pivot: bool = False, deleted_col: str = "is_deleted") -> DataFrame:
    """Live items per type; ``pivot`` turns the types into columns (pass
    ``types`` to avoid the distinct-values pass)."""
    if deleted_col in df.columns:
        df = df.filter(~F.coalesce(F.col(deleted_col), F.lit(False)))
    if types is not None:
        df = df.filter(F.col(type_col).isin(types))
    if pivot:
        return df.groupBy(*(by or [])).pivot(type_col, types).agg(F.count(F.lit(1)))
    return df.groupBy(*(by or []), type_col).agg(F.count(F.lit(1)).alias("item_count"))


# A4 / A5 ----------------------------------------------------------------------
def distinct_count_blank(df: DataFrame, col: str, by: list | None = None, name: str | None = None) -> DataFrame:
    return measure(df, {name or f"distinct_{col}": dcount_blank(col)}, None, by)


def conditional_counts(df: DataFrame, conditions: dict[str, Column], by: list | None = None) -> DataFrame:
    """One count per named condition, all in one pass."""
    return measure(df, {n: F.count(F.when(c, 1)) for n, c in conditions.items()}, None, by)


# A6 ---------------------------------------------------------------------------
def latest_snapshot(df: DataFrame, stamp_col: str, by: list | None = None) -> DataFrame:
    """Rows whose stamp equals the greatest stamp (globally, or per ``by``).

    Global: a scalar subquery.  Per group: the per-group maxima (one row per
    group after a partial aggregate) are joined back; a hot group's rows are
    split by AQE's skew-join handling.
    """
    if not by:
        return df.filter(F.col(stamp_col) == df.select(F.max(stamp_col)).scalar())
    m = df.groupBy(*by).agg(F.max(stamp_col).alias("_max"))
    return df.join(m, on=by).filter(F.col(stamp_col) == F.col("_max")).drop("_max")


# A12 / A13 ----------------------------------------------------------------------
def exact_sum(value: Column, decimals: int | None) -> Column:
    """Sum as a double; with ``decimals`` the addends are summed as decimals of
    that many places, so the result does not depend on summation order and is
    exact up to 38 digits (beyond, the sum raises an error)."""
    return _sum_as(F.sum, value, decimals)


def _sum_as(agg, value: Column, decimals: int | None) -> Column:
    """``agg(value)``, where ``agg`` may also be a windowed sum."""
    if decimals is None:
        return agg(value)
    return agg(value.cast(f"decimal(38,{decimals})")).cast("double")


def exact_avg(value: Column, decimals: int | None) -> Column:
    """Average as exact_sum / count (order-independent when ``decimals`` is set)."""
    if decimals is None:
        return F.avg(value)
    return exact_sum(value, decimals) / F.count(value)


def two_level(df: DataFrame, inner_by: list[str], value: Column, outer_by: list | None = None,
              stats=("avg", "max", "count"), decimals: int | None = None) -> DataFrame:
    """Sum ``value`` per (outer_by + inner_by), then average / max / count
    (non-blank) of those sums per ``outer_by``.  The first level is a
    partial+final hash aggregate; the second runs over one row per inner
    group, so a hot outer group is already reduced before its shuffle."""
    outer_by = outer_by or []
    first = df.groupBy(*outer_by, *inner_by).agg(exact_sum(value, decimals).alias("_s"))
    fn = {"avg": lambda c: exact_avg(F.col(c), decimals), "max": F.max, "min": F.min, "count": F.count,
          "sum": lambda c: exact_sum(F.col(c), decimals)}
    return first.groupBy(*outer_by).agg(*[fn[s]("_s").alias(f"{s}_value") for s in stats])


# A14 ---------------------------------------------------------------------------
def with_calendar_flags(df: DataFrame, date_col: str, today) -> DataFrame:
    """Attach the calendar's relative flags to each row, computed in place
    from the row's date (no join needed: the flags are functions of the
    date and ``today``)."""
    from ..sources.dims import calendar_columns
    flags = calendar_columns(F.to_date(F.col(date_col)), today)[-7:]
    return df.select("*", *flags)


def calendar_window_measures(df: DataFrame, date_col: str, today, value: Column | None = None,
                             by: list | None = None) -> DataFrame:
    """A measure (row count, or sum of ``value``) under each calendar window:
    current/previous month, year, quarter, last 14/30 days."""
    d = F.to_date(F.col(date_col))
    t = _lit_date(today)
    windows = {
        "current_month": (F.year(d) == F.year(t)) & (F.month(d) == F.month(t)),
        "previous_month": F.date_format(d, "yyyy-MM") == F.date_format(F.add_months(t, -1), "yyyy-MM"),
        "current_year": F.year(d) == F.year(t),
        "previous_year": F.year(d) == F.year(t) - 1,
        "current_quarter": (F.year(d) == F.year(t)) & (F.quarter(d) == F.quarter(t)),
        "last_14_days": d.between(F.date_add(t, -14), t),
        "last_30_days": d.between(F.date_add(t, -30), t),
    }
    agg = (lambda cond: F.count(F.when(cond, 1))) if value is None else (lambda cond: F.sum(F.when(cond, value)))
    return df.groupBy(*(by or [])).agg(*[agg(c).alias(n) for n, c in windows.items()])


# A15 ---------------------------------------------------------------------------
def rolling_counts(df: DataFrame, date_col: str, today, days=(7, 14, 30, 60, 90), by: list | None = None,
                   value: Column | None = None, distinct: str | None = None) -> DataFrame:
    """Measure over the last ``n`` days (``today - n`` .. ``today``) for each n."""
    d = F.to_date(F.col(date_col))
    t = _lit_date(today)
    out = []
    for n in days:
        cond = (d >= F.date_sub(t, n)) & (d <= t)
        if distinct:
            out.append(F.count_distinct(F.when(cond, F.col(distinct))).alias(f"last_{n}d"))
        elif value is None:
            out.append(F.count(F.when(cond, 1)).alias(f"last_{n}d"))
        else:
            out.append(F.sum(F.when(cond, value)).alias(f"last_{n}d"))
    return df.groupBy(*(by or [])).agg(*out)


# A16 ---------------------------------------------------------------------------
def month_over_month(df: DataFrame, date_col: str, aggs: dict[str, Column], by: list | None = None) -> DataFrame:
    """Monthly measures with the previous calendar month's value and the
    growth ``(this - previous) / previous`` (blank when previous is 0/blank).

    The previous month is a self-join of the (small) monthly aggregate on
    ``add_months(month, 1)``; months without a predecessor get blank growth.
    """
    by = by or []
    m = (df.withColumn("Month", F.trunc(F.to_date(F.col(date_col)), "month"))
         .groupBy(*by, "Month").agg(*[a.alias(n) for n, a in aggs.items()]))
    prev = m.select(*by, F.add_months("Month", 1).alias("Month"),
                    *[F.col(n).alias(f"prev_{n}") for n in aggs])
    j = m.join(prev, on=[*by, "Month"], how="left")
    return j.select(*by, "Month", *aggs.keys(), *[f"prev_{n}" for n in aggs],
                    *[ddivide(F.col(n) - F.col(f"prev_{n}"), F.col(f"prev_{n}")).alias(f"growth_{n}") for n in aggs])


# A17 / W2 ----------------------------------------------------------------------
def trailing_average(df: DataFrame, item_col: str, date_col: str, value: Column, days: int = 30,
                     decimals: int | None = None) -> DataFrame:
    """Daily sums per item, the trailing ``days`` average of the item's
    daily sums (dates ``d-days .. d``) and the ratio ``(trailing - daily) /
    trailing``.

    The window is per item over at most one row per day, so a hot item's
    partition is bounded by the number of days, not by its raw rows.
    """
    daily = (df.groupBy(item_col, F.to_date(F.col(date_col)).alias("Date"))
             .agg(exact_sum(value, decimals).alias("daily_value")))
    daynum = F.unix_date(F.col("Date"))
    w = Window.partitionBy(item_col).orderBy(daynum).rangeBetween(-days, 0)
    if decimals is None:
        avg = F.avg("daily_value").over(w)
    else:
        avg = _sum_as(lambda c: F.sum(c).over(w), F.col("daily_value"), decimals) / F.count("daily_value").over(w)
    out = daily.withColumn("trailing_avg", avg)
    return out.withColumn("trend_ratio", ddivide(F.col("trailing_avg") - F.col("daily_value"), F.col("trailing_avg")))


def window_trend(df: DataFrame, item_col: str | None, date_col: str, today, value: Column | None = None, short: int = 14, long: int = 30,
                 by: list | None = None, decimals: int | None = None) -> DataFrame:
    """A measure over the last ``short`` days against the last ``long`` days
    (today included): both, and ``(short - long) / long``.  With ``item_col``
    the measure is the average of the (item, day) sums of ``value``, without
    it the number of rows."""
    d, t, by = F.to_date(F.col(date_col)), _lit_date(today), list(by or [])
    if item_col is None:
        rows, agg = df.withColumn("_d", d), lambda cond: F.count(F.when(cond, 1))
    else:
        rows = df.groupBy(*by, item_col, d.alias("_d")).agg(exact_sum(value, decimals).alias("_v"))
        agg = lambda cond: exact_avg(F.when(cond, F.col("_v")), decimals)
    last = lambda n: (F.col("_d") >= F.date_sub(t, n)) & (F.col("_d") <= t)
    out = rows.groupBy(*by).agg(agg(last(short)).alias(f"last_{short}d"), agg(last(long)).alias(f"last_{long}d"))
    return out.withColumn("trend", ddivide(F.col(f"last_{short}d") - F.col(f"last_{long}d"), F.col(f"last_{long}d")))


# A18 / A19 -----------------------------------------------------------------------
def utilisation(df: DataFrame, used, capacity, by: list | None = None, decimals: int | None = None) -> DataFrame:
    """Total used / total available (blank when nothing is available)."""
    u, c = exact_sum(_c(used), decimals), exact_sum(_c(capacity), decimals)
    return measure(df, {"used": u, "available": c, "utilisation": ddivide(u, c)}, None, by)


def throttling_counts(df: DataFrame, cols: dict, by: list | None = None, threshold: float = 1.0) -> DataFrame:
    """Time points where a percentage column exceeds ``threshold`` (1 = 100 %)."""
    return conditional_counts(df, {n: _c(c) > threshold for n, c in cols.items()}, by)


# A20 ---------------------------------------------------------------------------
def refresh_schedule_slots(days: DataFrame, times: DataFrame, keys: list[str], enabled_col: str = "Enabled",
                           day_col: str = "Day", time_col: str = "Time") -> DataFrame:
    """Distinct (keys, day, time, enabled) slots of the refresh schedules.

    The per-item join of days x times is bounded by 7 days x 48 times per
    item, so it cannot blow up whatever the number of items."""
    d = days.select(*keys, day_col, enabled_col).distinct()
    t = times.select(*keys, time_col).distinct()
    return d.join(t, on=keys).distinct()


def refresh_slot_counts(slots: DataFrame, by: list | None = None, enabled_col: str = "Enabled") -> DataFrame:
    return conditional_counts(slots, {"slots_enabled": F.col(enabled_col) == True,  # noqa: E712
                                      "slots_disabled": F.col(enabled_col) == False,  # noqa: E712
                                      "slots_any": F.lit(True)}, by)


# A21 ---------------------------------------------------------------------------
def outliers(df: DataFrame, item_col: str, date_col: str, value: Column, decimals: int | None = None) -> DataFrame:
    """Outlier analysis per item and day.

    ``avg_all_days`` = the item's average daily sum; ``daily_vs_avg`` = daily
    sum - average; ``outlier_factor`` = (daily_vs_avg - avg) / avg.  The
    factor subtracts the average a second time, exactly as the source
    measure does; ``outlier_factor_intended`` gives (daily - avg) / avg.
    The per-item average is a grouped aggregate joined back by item.
    """
    daily = (df.groupBy(item_col, F.to_date(F.col(date_col)).alias("Date"))
             .agg(exact_sum(value, decimals).alias("daily_value")))
    avg = daily.groupBy(item_col).agg(exact_avg(F.col("daily_value"), decimals).alias("avg_all_days"))
    j = daily.join(avg, item_col)
    diff = F.col("daily_value") - F.col("avg_all_days")
    return j.select(item_col, "Date", "daily_value", "avg_all_days", diff.alias("daily_vs_avg"),
                    ddivide(diff - F.col("avg_all_days"), F.col("avg_all_days")).alias("outlier_factor"),
                    ddivide(diff, F.col("avg_all_days")).alias("outlier_factor_intended"))


# A22 ---------------------------------------------------------------------------
def unused_indicators(entities: DataFrame, key: str, metrics) -> DataFrame:
    """Unused-entity indicators and score.

    ``metrics`` is either one DataFrame ``(key, metric1, metric2, ...)``
    (preferred: all metrics from one aggregation pass, one join) or a dict
    mapping an indicator name to a DataFrame ``(key, value)``.  Indicator =
    1 when the metric is below 1 (a missing metric counts as 0), else null;
    score = sum / number of indicators, null when none fires.
    """
    out = entities.select(key).distinct()
    if isinstance(metrics, DataFrame):
        names = [c for c in metrics.columns if c != key]
        out = out.join(metrics.select(key, *[F.col(c).alias(f"_{c}") for c in names]), key, "left")
    else:
        names = list(metrics)
        for name, m in metrics.items():
            agg = m.groupBy(key).agg(F.sum(F.col(m.columns[1])).alias(f"_{name}"))
            out = out.join(agg, key, "left")
    metrics = names
    ind = {f"unused_{n}": F.when(blank0(F.col(f"_{n}")) < 1, F.lit(1)) for n in metrics}
    out = out.select(key, *[c.alias(n) for n, c in ind.items()])
    total = sum((F.coalesce(F.col(n), F.lit(0)) for n in ind), F.lit(0))
    return out.withColumn("unused_score", F.when(total > 0, total / float(len(metrics))))


# A23 ---------------------------------------------------------------------------
def first_value(df: DataFrame, by: list[str], col: str, default: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.coalesce(F.min(col), F.lit(default)).alias(name))


# A24 ---------------------------------------------------------------------------
def run_comparison(df: DataFrame, model_col: str, run_col: str, metrics: dict[str, Column],
                   decimals: dict[str, int] | None = None) -> DataFrame:
    """Per model: last run id, previous run id (last - 1, null when <= 0),
    each metric at both runs and the difference previous - last.

    The last run per model is a grouped max joined back by model (one row
    per model on the small side), then one conditional aggregate."""
    decimals = decimals or {}
    last = df.groupBy(model_col).agg(F.max(run_col).alias("last_run"))
    j = df.join(last, model_col)
    prev = F.when(F.col("last_run") - 1 > 0, F.col("last_run") - 1)
    aggs = []
    cols = [F.max("last_run").alias("last_run"), F.max(prev).alias("previous_run")]
    for n, m in metrics.items():
        cols.append(exact_sum(F.when(F.col(run_col) == F.col("last_run"), m), decimals.get(n)).alias(f"{n}_last"))
        cols.append(exact_sum(F.when(F.col(run_col) == prev, m), decimals.get(n)).alias(f"{n}_previous"))
    out = j.groupBy(model_col).agg(*aggs, *cols)
    return out.withColumns({f"{n}_diff": F.col(f"{n}_previous") - F.col(f"{n}_last") for n in metrics})


# A25 / A26 / A27 ------------------------------------------------------------------
def size_measures(df: DataFrame, cols: list[str], by: list | None = None, unit: str = "bytes") -> DataFrame:
    div = float(SIZE_UNITS[unit])
    return df.groupBy(*(by or [])).agg(*[(F.sum(c) / div).alias(f"{c}_{unit}") for c in cols])


def storage_breakdown(df: DataFrame, table_id: str = "TABLE_ID", size: str = "USED_SIZE",
                      segment: str = "SEGMENT_NUMBER", column_type: str = "COLUMN_TYPE",
                      dictionary: str = "DICTIONARY_SIZE", by: list | None = None) -> DataFrame:
    """Storage size by table-id prefix: data (2nd char not '$'), hierarchy
    ('H$' with segment 0), user hierarchy ('U$'), relationship ('R$'),
    dictionary (from BASIC_DATA rows) and total."""
    tid, sz = F.col(table_id), F.col(size)
    p2 = F.substr(tid, F.lit(1), F.lit(2))
    data = F.sum(F.when(F.substr(tid, F.lit(2), F.lit(1)) != "$", sz))
    hier = F.sum(F.when((p2 == "H$") & (F.col(segment) == 0), sz))
    uh = F.sum(F.when(p2 == "U$", sz))
    rel = F.sum(F.when(p2 == "R$", sz))
    dic = (F.sum(F.when(F.col(column_type) == "BASIC_DATA", F.col(dictionary)))
           if column_type in df.columns else F.lit(None))
    out = df.groupBy(*(by or [])).agg(data.alias("data_size"), hier.alias("hierarchy_size"),
                                      uh.alias("user_hierarchy_size"), rel.alias("relationship_size"),
                                      dic.alias("dictionary_size"))
    return out.withColumn("total_size", sum((blank0(F.col(c)) for c in
                                             ["data_size", "hierarchy_size", "user_hierarchy_size",
                                              "relationship_size", "dictionary_size"]), F.lit(0)))


def exact_median(df: DataFrame, col: str, by: list | None = None, name: str = "median") -> DataFrame:
    """Exact median per group (average of the two middle values when the
    count is even) without holding a group's values in one task.

    Built on :func:`windows.prefix_counts`: rows are reduced to (group,
    value, count), range-partitioned so a hot group spans many tasks, and
    each value learns how many rows precede it; the values covering the
    middle ranks are then picked with a grouped aggregate.  (Spark's
    ``median`` merges one value map per group in a single task.)"""
    from .windows import prefix_counts
    by = list(by or [])
    pc = prefix_counts(df, by, col)
    lo_k, hi_k = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    covers = lambda k: (F.col("before") < k) & (F.col("before") + F.col("w") >= k)
    v = F.col(col)
    return pc.groupBy(*by).agg(((F.max(F.when(covers(lo_k), v)) + F.max(F.when(covers(hi_k), v))) / 2.0).alias(name))


def distribution_stats(df: DataFrame, col: str, by: list | None = None, prefix: str | None = None,
                       decimals: int | None = None) -> DataFrame:
    """avg / exact median / min / max / sum / count of a column (the median
    from :func:`exact_median`, joined on the group keys)."""
    p = prefix or col
    c = F.col(col)
    by = list(by or [])
    stats = df.groupBy(*by).agg(exact_avg(c, decimals).alias(f"{p}_avg"),
                                F.min(c).alias(f"{p}_min"), F.max(c).alias(f"{p}_max"),
                                exact_sum(c, decimals).alias(f"{p}_sum"), F.count(c).alias(f"{p}_count"))
    from .windows import _join_null_safe
    med = exact_median(df, col, by, f"{p}_median")
    return _join_null_safe(stats, med, by) if by else _join_scalar(stats, med)


def _join_scalar(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to a one-row aggregate."""
    col = one_row.columns[0]
    return left.withColumn(col, one_row.select(col).scalar())


# A28 / A29 ----------------------------------------------------------------------
def health_flags(objects: dict[str, DataFrame], model_col: str, error_col: str = "ErrorMessage",
                 state_col: str = "State") -> DataFrame:
    """Per model and object kind: errors + not-Ready objects = 0 -> healthy;
    the model is healthy when every kind is."""
    parts = []
    for kind, df in objects.items():
        err = F.count(F.when(F.nullif(F.col(error_col), F.lit("")).isNotNull(), 1)) if error_col in df.columns else F.lit(0)
        nr = F.count(F.when(F.col(state_col) != "Ready", 1)) if state_col in df.columns else F.lit(0)
        parts.append(df.groupBy(model_col).agg((err + nr).alias("_bad")).withColumn("kind", F.lit(kind)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    piv = u.groupBy(model_col).pivot("kind", list(objects)).agg(F.sum("_bad"))
    out = piv.select(model_col, *[(F.coalesce(F.col(k), F.lit(0)) == 0).alias(f"{k}_healthy") for k in objects])
    return out.withColumn("model_healthy", F.expr(" AND ".join(f"`{k}_healthy`" for k in objects)))


def documentation_ratio(df: DataFrame, desc_col: str, by: list | None = None, name: str = "documented_ratio") -> DataFrame:
    described = F.count(F.nullif(F.trim(F.col(desc_col)), F.lit("")))
    return measure(df, {name: ddivide(described, F.count(F.lit(1)))}, None, by)


# A30 / A31 ----------------------------------------------------------------------
def attach_sum(target: DataFrame, facts: DataFrame, keys: list[str], value: str, name: str,
               decimals: int | None = None) -> DataFrame:
    """Sum of ``value`` per key attached to each target row (left join of
    the pre-aggregated facts: one row per key crosses the join)."""
    s = facts.groupBy(*keys).agg(exact_sum(F.col(value), decimals).alias(name))
    return target.join(s, keys, "left")


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Each row's share of the column total (the total is a scalar subquery:
    one aggregate, no single-partition window)."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, ddivide(F.col(value), total))


# A32-A37 ------------------------------------------------------------------------
def counter_averages(df: DataFrame, name_col: str, value_col: str, counters: dict[str, str],
                     by: list | None = None, scale: dict[str, float] | None = None,
                     decimals: int | None = None) -> DataFrame:
    """Average of rows with one counter name, one column per counter
    (a pivot by conditional aggregation: one pass, no per-counter scan)."""
    scale = scale or {}
    return df.groupBy(*(by or [])).agg(*[
        (exact_avg(F.when(F.col(name_col) == cn, F.col(value_col)), decimals) * scale.get(out, 1.0)).alias(out)
        for out, cn in counters.items()])


def success_ratio(df: DataFrame, request_col: str, status_col: str, success_value="Y", failure_value="N",
                  by: list | None = None) -> DataFrame:
    """Distinct requests, distinct failed requests (status ``failure_value``;
    other values are neither) and the success ratio."""
    ok = F.col(status_col) == success_value
    return df.groupBy(*(by or [])).agg(
        F.count_distinct(request_col).alias("requests"),
        F.count_distinct(F.when(F.col(status_col) == failure_value, F.col(request_col))).alias("failed_requests"),
        ddivide(F.count_distinct(F.when(ok, F.col(request_col))), F.count_distinct(request_col)).alias("success_ratio"))


def time_measures(df: DataFrame, cols: list[str], by: list | None = None, unit: str = "milliseconds") -> DataFrame:
    div = float(TIME_UNITS[unit])
    aggs = []
    for c in cols:
        aggs += [(F.sum(c) / div).alias(f"sum_{c}"), (F.max(c) / div).alias(f"max_{c}"),
                 (F.avg(c) / div).alias(f"avg_{c}")]
    return df.groupBy(*(by or [])).agg(*aggs, F.count(F.lit(1)).alias("rows"))


# A38 ---------------------------------------------------------------------------
def item_vs_all(df: DataFrame, item_col: str, date_col: str, value: Column, today,
                item_days: int = 7, all_days: int = 90, decimals: int | None = None) -> DataFrame:
    """Per item: average daily value over the last ``item_days`` against the
    average of all (item, day) sums of the last ``all_days`` (item filter
    removed, day ``today - all_days`` included): difference, percentage and
    whether it is above.  The all-items baseline is a scalar subquery."""
    t = _lit_date(today)
    d = F.to_date(F.col(date_col))
    daily = df.groupBy(item_col, d.alias("Date")).agg(exact_sum(value, decimals).alias("v"))
    base = (daily.filter((F.col("Date") >= F.date_sub(t, all_days)) & (F.col("Date") <= t))
            .select(exact_avg(F.col("v"), decimals)).scalar())
    recent = (daily.filter((F.col("Date") >= F.date_sub(t, item_days)) & (F.col("Date") <= t))
              .groupBy(item_col).agg(exact_avg(F.col("v"), decimals).alias("item_avg")))
    out = recent.withColumn("all_avg", base)
    diff = F.col("item_avg") - F.col("all_avg")
    return out.withColumns({"difference": diff, "difference_pct": ddivide(diff, F.col("all_avg")),
                            "above": diff > 0})


# A39 ---------------------------------------------------------------------------
def usage_rollup(df: DataFrame, by: list[str], sums: dict, cu_col: str, date_col: str = "Date") -> DataFrame:
    """Usage rolled up by ``by``: named sums, rows with CU > 0 only, a
    ``yyyyMMdd`` DateKey; callers order by CU descending when presenting.
    ``sums`` maps output name to a column, or to ``(column, decimals)``."""
    aggs = []
    for n, spec in sums.items():
        c, d = spec if isinstance(spec, tuple) else (spec, None)
        aggs.append(exact_sum(_c(c), d).alias(n))
    out = df.groupBy(*by).agg(*aggs)
    out = out.filter(F.col(cu_col) > 0)
    if date_col in by:
        out = out.withColumn("DateKey", F.date_format(F.col(date_col), "yyyyMMdd"))
    return out


# A40 ---------------------------------------------------------------------------
def kql_summary(df: DataFrame, by: list[str], value: Column, exact: bool = True,
                distinct_col: str | None = None) -> DataFrame:
    """avg / sum of an integer-cast value divided by 1000, count, and an
    (exact or approximate) distinct count."""
    v = value.cast("int")
    aggs = [(F.avg(v) / 1000).alias("avg_sec"), (F.sum(v) / 1000).alias("sum_sec"), F.count(F.lit(1)).alias("n")]
    if distinct_col:
        aggs.append((F.count_distinct(distinct_col) if exact else F.approx_count_distinct(distinct_col)).alias("dcount"))
    return df.groupBy(*by).agg(*aggs)


# A35 ---------------------------------------------------------------------------
def mashup_by_end_date(mashup: DataFrame, executions: DataFrame, date_col: str = "EndDate",
                       exec_date_col: str = "QueryExecutionEndDate", decimals: int | None = None) -> DataFrame:
    """Mashup evaluation measures per end date, with the executed requests
    of that date: avg/max commit, working set, processor percent, total
    processor time, rows, distinct requests.  ``Max Working Set`` averages
    the per-row maxima, as the source measure does."""
    m = mashup.groupBy(date_col).agg(
        exact_avg(F.col("AverageCommit(byte)"), decimals).alias("avg_commit"),
        F.max("MaxCommit(byte)").alias("max_commit"),
        exact_avg(F.col("AverageWorkingSet(byte)"), decimals).alias("avg_working_set"),
        exact_avg(F.col("MaxWorkingSet(byte)"), decimals).alias("max_working_set_avg"),
        exact_avg(F.col("AveragePercentProcessorTime"), decimals).alias("avg_processor_pct"),
        F.max("MaxPercentProcessorTime").alias("max_processor_pct"),
        exact_sum(F.col("TotalProcessorTime(ms)"), decimals).alias("total_processor_ms"),
        exact_sum(F.col("TotalRowsSum"), decimals).alias("total_rows"))
    e = executions.groupBy(F.col(exec_date_col).alias(date_col)).agg(F.count_distinct("RequestId").alias("requests"))
    return m.join(e, date_col, "left")


# A36 ---------------------------------------------------------------------------
def request_context_values(evaluation: DataFrame, by: str = "RequestId") -> DataFrame:
    """Per request: the refresh workspace id (greatest) and the model id
    (least) from the evaluation context.  (The source measures filter the
    application-context table by keys it never holds and are always blank;
    the evaluation context is where these keys live.)"""
    return evaluation.groupBy(by).agg(
        F.max(F.when(F.col("key") == "WorkspaceId", F.col("value"))).alias("RefreshWorkspaceId"),
        F.min(F.when(F.col("key") == "DatasetId", F.col("value"))).alias("SemanticModelId"))


# A37 ---------------------------------------------------------------------------
def sql_request_measures(history: DataFrame, by: list | None = None, unit: str = "seconds") -> DataFrame:
    """SQL request measures: elapsed and CPU time (sum, max) in ``unit``,
    rows, result-cache hits, data scanned from disk / memory / remote
    storage (MB), request count and success rate."""
    div = float(TIME_UNITS[unit])
    ok = F.lower(F.col("status")) == "succeeded"
    return history.groupBy(*(by or [])).agg(
        (F.sum("total_elapsed_time_ms") / div).alias("elapsed"), (F.max("total_elapsed_time_ms") / div).alias("max_elapsed"),
        (F.sum("allocated_cpu_time_ms") / div).alias("cpu"), (F.max("allocated_cpu_time_ms") / div).alias("max_cpu"),
        F.sum("row_count").alias("rows"), F.max("row_count").alias("max_rows"),
        F.count(F.when(F.col("result_cache_hit").cast("int") == 2, 1)).alias("cache_hits"),
        F.sum("data_scanned_disk_mb").alias("scanned_disk_mb"), F.sum("data_scanned_memory_mb").alias("scanned_memory_mb"),
        F.sum("data_scanned_remote_storage_mb").alias("scanned_remote_mb"),
        F.count(F.lit(1)).alias("requests"),
        ddivide(F.count(F.when(ok, 1)), F.count(F.lit(1))).alias("success_rate"))
