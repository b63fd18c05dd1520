import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quittance import functions as q

NUMBERS = [
    "12.7", "12.5", "-12.5", "1e3", "12.0", " 12 ", "+12", "abc", "", " ", "NULL", "null", " NULL ", "99999999999",
    "2147483647.4", ".5", "5.", "1.005", "-1.005", "1,000.00", "$5", "nan", "inf", "1e17", "12345678901234567.891",
    "1e-3", "--5", "- 5", "1 000", "\t5\t", "1e", "2.5e0", "-0.00", "-0.004", None,
]
DAYS = [
    "2025-01-06", "2025-1-6", "2025/01/06", "2025", "2025-01", "2025-01-06 12:00:00", "2025-01-06T12:00",
    "2025-01-06T12:00:00Z", "2025-13-01", "20250106", "06/01/2025", "2025-01-06 12", "2025-01-06 25:00:00",
    "2025-01-06 12:00:00.123456", "2025-01-06 1:2:3", "2025-01-06x", "2025-02-30", "2025 01 06", "now", "NULL", "",
    "12:00:00", "2025-01/06", "2025-01-06 12:00:60", None,
]
TIMES = [
    "12:00:00", "9:05", "09:05", "9:5:3", "09:05:00.250", "25:00:00", "12", "1200", "NULL", "", "12:00 PM",
    "2025-01-06 12:00:00", "23:59:60", None,
]


def values(spark, texts, expression, schema="i int, v string"):
    frame = spark.createDataFrame(list(enumerate(texts)), schema)
    rows = frame.select("i", expression(F.col("v")).cast("string").alias("x")).collect()
    return [r.x for r in sorted(rows)]


def duck(texts, expression):
    connection = duckdb.connect()
    return [connection.execute(f"select cast({expression} as varchar)", [t]).fetchone()[0] for t in texts]


CLEAN = "nullif(nullif(trim(cast($1 as varchar)), ''), 'NULL')"


@pytest.mark.parametrize(
    "texts, mine, theirs",
    [
        (NUMBERS, q.clean_text, CLEAN),
        (NUMBERS, q.to_amount, f"try_cast({CLEAN} as decimal(18,2))"),
        (NUMBERS, q.to_count, "try_cast(cast($1 as varchar) as integer)"),
        (DAYS, q.to_date, "try_cast(cast($1 as varchar) as date)"),
        (DAYS, q.to_timestamp, "try_cast(cast($1 as varchar) as timestamp)"),
        (TIMES, q.to_time, "try_cast(cast($1 as varchar) as time)"),
        (["true", "TRUE", "True", " true", "false", "1", "", None], q.to_flag, "lower(coalesce($1, 'false')) = 'true'"),
    ],
    ids=["text", "amount", "count", "date", "timestamp", "time", "flag"],
)
def test_parses_like_the_warehouse(spark, texts, mine, theirs):
    assert values(spark, texts, mine) == duck(texts, theirs)


def test_time_type_holds_the_same_times(spark):
    native = values(spark, TIMES, lambda c: q.to_time(c, native=True))
    assert native == values(spark, TIMES, q.to_time)


def test_popular_flag_is_exact(spark):
    flag = lambda c: q.to_flag(c, "1", fold_case=False)
    assert values(spark, ["1", "0", " 1", None], flag) == ["true", "false", "false", "false"]


def test_strict_date_accepts_dates_and_missing(spark):
    assert values(spark, ["2025-01-06", None, "2025-01-06 10:00:00"], q.to_date_strict) == [
        "2025-01-06",
        None,
        "2025-01-06",
    ]


@pytest.mark.parametrize("bad", ["NULL", "", "2025", "06/01/2025"])
def test_strict_date_refuses_other_text(spark, bad):
    with pytest.raises(Exception, match="not a date"):
        values(spark, [bad], q.to_date_strict)


def test_key_is_null_if_a_part_is(spark):
    frame = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "x string, y string")
    keys = [r[0] for r in frame.select(q.key_of(F.col("x"), q.or_empty(F.col("y")))).collect()]
    assert keys[0] == duck(["a|b"], "md5($1)")[0]
    assert keys[1] is None
    assert keys[2] == duck(["a|"], "md5($1)")[0]


def test_total_counts_missing_as_nothing(spark):
    frame = spark.createDataFrame([(1, None), (None, None)], "a int, b int").select(
        F.col("a").cast("decimal(18,2)"), F.col("b").cast("decimal(18,2)")
    )
    assert [float(r[0]) for r in frame.select(q.total("a", "b")).collect()] == [1.0, 0.0]


def test_rate_without_a_positive_whole_is_null(spark):
    frame = spark.createDataFrame([(1, 0), (1, -2), (1, None), (1, 8)], "p int, w int")
    rates = [r[0] for r in frame.select(q.per_unit(F.col("p"), F.col("w"), 2, times=100)).collect()]
    assert rates == [None, None, None, 12.5]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=200))
def test_rounds_like_the_warehouse(spark, thousandths):
    numbers = [n / 1000 for n in thousandths] + [1.005, -1.005, 2.675, 0.125, -0.125, -0.001, 0.0, -0.0]
    frame = spark.createDataFrame(list(enumerate(numbers)), "i int, v double")
    mine = [r.x for r in sorted(frame.select("i", q.round_away(F.col("v"), 2).alias("x")).collect())]
    connection = duckdb.connect()
    theirs = [connection.execute("select round($1::double, 2)", [n]).fetchone()[0] for n in numbers]
    assert list(map(repr, mine)) == list(map(repr, theirs))
