"""Distinct users from daily state, and facts met by table."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from govlake.operators import daily as DY
from govlake.operators import drill as DR
from govlake.operators import versions as V

TODAY = dt.date(2024, 3, 10)


def feed(spark, seed, first, last):
    rnd = random.Random(seed)
    data = [(rnd.choice("ab"), TODAY - dt.timedelta(days=rnd.randint(first, last)), rnd.choice([None, *[f"u{n}" for n in range(12)]])) for _ in range(60)]
    return spark.createDataFrame(data, "kind string, at date, user string"), data


def counted(data, kinds, windows):
    """A missing user counts as one."""
    return {k: tuple(len({u for kind, at, u in data if kind in kinds[k] and inside(at)}) for inside in windows) for k in kinds}


def back(n):
    return lambda d: 0 <= (TODAY - d).days <= n


def month(year, m):
    return lambda d: (d.year, d.month) == (year, m)


WINDOWS = [back(7), back(14), back(30), back(60), back(90), back(180), month(2024, 3), month(2024, 2),
           lambda d: (d.year, (d.month - 1) // 3) == (2024, 0), lambda d: (d.year, (d.month - 1) // 3) == (2023, 3), lambda d: d.year == 2024, lambda d: d.year == 2023]


def test_windows_equal_the_counted_sets(spark):
    df, data = feed(spark, 1, -5, 250)
    numbers = spark.createDataFrame(
        [(f"u{n}", 2 + n * 40_000) for n in range(12)], "user string, number long")  # one bitmap a user
    state = DY.daily_sets(df, "at", "user", numbers, ["kind"])
    got = {r[0]: tuple(r)[1:] for r in DY.window_users(state, DY.all_windows(TODAY), ["kind"]).collect()}
    assert got == counted(data, {"a": "a", "b": "b"}, WINDOWS)
    total = tuple(DY.window_users(state, DY.all_windows(TODAY)).first())
    assert total == counted(data, {"": "ab"}, WINDOWS)[""]


def test_groups_outside_every_window_and_empty_state(spark):
    df = spark.createDataFrame([("old", dt.date(2000, 1, 1), "u"), ("new", TODAY, None)], "kind string, at date, user string")
    state = DY.daily_sets(df, "at", "user", spark.createDataFrame([("u", 2)], "user string, number long"), ["kind"])
    assert rows(DY.window_users(state, DY.rolling(TODAY, (7,)), ["kind"])) == [("new", 1), ("old", 0)]
    assert DY.window_users(state.limit(0), DY.rolling(TODAY, (7,)), ["kind"]).count() == 0


def test_days_loaded_again_replace_their_state_only(spark, tmp_path):
    state, numbers = V.Versions(spark, f"{tmp_path}/s", "day"), V.Buckets(spark, f"{tmp_path}/n", ["user"], 4)
    one, data1 = feed(spark, 2, 10, 40)
    two, data2 = feed(spark, 3, 0, 15)
    DY.load_days(state, numbers, one, "at", "user", ["kind"])
    known = {r["user"]: r["number"] for r in numbers.rows().collect()}
    v = DY.load_days(state, numbers, two, "at", "user", ["kind"])
    days = {at for _, at, _ in data2}
    assert state.changed(v) == {f"day={d}" for d in days}
    after = {r["user"]: r["number"] for r in numbers.rows().collect()}
    assert known.items() <= after.items() and len(set(after.values())) == len(after) == 12 and min(after.values()) > DY.BLANK
    data = [x for x in data1 if x[1] not in days] + data2
    got = {r[0]: tuple(r)[1:] for r in DY.window_users(state.read(), DY.all_windows(TODAY), ["kind"]).collect()}
    assert got == counted(data, {"a": "a", "b": "b"}, WINDOWS)
    week = DY.days_of(state, TODAY, 7)
    assert {r["kind"]: r["last_7d"] for r in DY.window_users(week, DY.rolling(TODAY, (7,)), ["kind"]).collect()} == {k: v[0] for k, v in got.items()}
    assert all(TODAY - dt.timedelta(days=7) <= r["day"] <= TODAY for r in week.select("day").distinct().collect())


def test_one_scan_answers_all_windows(spark, tmp_path):
    df, _ = feed(spark, 4, 0, 60)
    numbers = spark.createDataFrame([(f"u{n}", 2 + n) for n in range(12)], "user string, number long")
    DY.daily_sets(df, "at", "user", numbers).write.parquet(f"{tmp_path}/state")
    plan = DY.window_users(spark.read.parquet(f"{tmp_path}/state"), DY.all_windows(TODAY))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_sketches_are_close(spark):
    df = spark.range(30_000).select(F.lit("x").alias("kind"), F.expr(f"date_sub(date'{TODAY}', cast(id % 90 as int))").alias("at"), (F.col("id") % 20_011).cast("string").alias("user"))
    got = DY.window_users(DY.daily_sketches(df, "at", "user", ["kind"]), DY.rolling(TODAY), ["kind"]).first()
    exact = df.agg(*[F.count_distinct(F.when(F.datediff(F.lit(str(TODAY)).cast("date"), "at") <= n, F.col("user"))) for n in (7, 14, 30, 60, 90, 180)]).first()
    assert all(abs(a / b - 1) < 0.05 for a, b in zip(tuple(got)[1:], exact))


def test_drill_across_never_multiplies(spark):
    one = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "k string, v long")
    two = spark.createDataFrame([("a", 10), ("a", 20), ("b", 30), (None, 7)], "k string, w long")
    got = DR.drill_across([(one, {"v": F.sum("v")}), (two, {"w": F.sum("w"), "n": F.count(F.lit(1))})], "k")
    assert rows(got) == rows(spark.createDataFrame([("a", 3, 30, 2), ("b", None, 30, 1), (None, 5, 7, 1)], "k string, v long, w long, n long"))


def test_table_statistics(spark):
    mb = 1 << 20
    f = lambda data, schema: spark.createDataFrame(data, "TableId string, " + schema if schema else "TableId string")
    stat = DR.table_statistics(
        f([("t", "Sales"), ("u", "Dates"), ("v", "Empty"), ("w", "Counted")], "TableName string"), f([("t",), ("t",), ("u",), ("x",), ("w",)], ""),
        f([("t", 10), ("t", 5)], "RecordCount long"), f([("t", 3), ("t", 4), ("u", 1)], "DistinctStates long"),
        f([("t", "I8", "BASIC_DATA", 2 * mb), ("t", "N/A", "BASIC_DATA", 9 * mb), ("t", "I8", "HIERARCHY", 9 * mb)], "DATATYPE string, COLUMN_TYPE string, DICTIONARY_SIZE long"),
        f([("t", "T (1)", 0, mb), ("t", "H$T", 0, 2 * mb), ("t", "H$T", 1, 9 * mb), ("t", "U$T", 0, mb), ("t", "R$T", 3, mb), ("u", "D", 0, 3 * mb), ("x", "X", 0, 90 * mb)],
          "TABLE_ID string, SEGMENT_NUMBER long, USED_SIZE long"))
    got = {r["TableId"]: tuple(r)[2:] for r in stat.collect()}
    assert got == {"t": (2, 15, 7, 2.0, 1.0, 2.0, 7.0, 0.7, "Sales | Col: 2 | Sum Size: 7.0 MB | Rows: 15"),
                   "u": (1, None, 1, None, 3.0, None, 3.0, 0.3, "Dates | Col: 1 | Sum Size: 3.0 MB | Rows: "), "w": (1, None, None, None, None, None, None, None, "Counted | Col: 1 | Sum Size:  MB | Rows: ")}
