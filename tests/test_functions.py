import datetime as dt

from pyspark.sql import functions as F

from starpipe.functions.scalar import date_key, duration_minutes, safe_cast, valid_date


def test_safe_cast_turns_bad_values_into_null(spark):
    df = spark.createDataFrame([("12", "2020-01-05", "2020-01-05 10:00:00", "true"),
                                ("x1", "31/12/2015", "not a time", "maybe")],
                               "a string, d string, t string, b string")
    rows = df.select(safe_cast("a", "long").alias("a"), safe_cast("d", "date").alias("d"),
                     safe_cast("t", "timestamp").alias("t"), safe_cast("b", "boolean").alias("b")).collect()
    assert rows[0]["a"] == 12 and rows[0]["d"] == dt.date(2020, 1, 5)
    assert rows[0]["t"] == dt.datetime(2020, 1, 5, 10) and rows[0]["b"] is True
    assert rows[1]["a"] is None and rows[1]["d"] is None and rows[1]["t"] is None and rows[1]["b"] is None


def test_safe_cast_timestamp_is_zone_less(spark):
    df = spark.createDataFrame([("2020-03-08 02:30:00",)], "t string")
    out = df.select(safe_cast("t", "timestamp").alias("t"))
    assert out.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert out.first()["t"] == dt.datetime(2020, 3, 8, 2, 30)


def test_date_key(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (None,)], "d date")
    assert [r[0] for r in df.select(date_key("d")).collect()] == [20240229, None]


def test_duration_minutes_edges(spark):
    rows = [
        ("2024-01-01 08:00:00", "2024-01-01 09:30:59"),   # 90.98 min -> 90
        ("2024-01-01 08:00:00", "2024-01-01 08:00:00"),   # equal -> 0
        ("2024-01-01 09:00:00", "2024-01-01 08:00:00"),   # end before start -> NULL
        (None, "2024-01-01 08:00:00"),
        ("2024-01-01 08:00:00", None),
        ("2024-01-01 08:00:00.900", "2024-01-01 08:01:00.100"),  # fractions dropped: 60 s -> 1
    ]
    df = spark.createDataFrame(rows, "s string, e string").select(
        F.col("s").cast("timestamp_ntz").alias("s"), F.col("e").cast("timestamp_ntz").alias("e"))
    got = [r[0] for r in df.select(duration_minutes("s", "e")).collect()]
    assert got == [90, 0, None, None, None, 1]


def test_valid_date_bounds(spark):
    raw = ["1899-12-31", "1900-01-01", "2025-06-30", "2025-07-01", "31/12/2015", "2020-1-5", None]
    df = spark.createDataFrame([(r,) for r in raw], "r string").withColumn("d", safe_cast("r", "date"))
    got = [x[0] for x in df.select(valid_date("d", as_of="2025-06-30")).collect()]
    assert got == [None, dt.date(1900, 1, 1), dt.date(2025, 6, 30), None, None, dt.date(2020, 1, 5), None]
    strict = [x[0] for x in df.select(valid_date("d", as_of="2025-06-30", raw="r")).collect()]
    assert strict[5] is None  # loosely written text fails the strict pattern check


def test_valid_date_defaults_to_today(spark):
    df = spark.createDataFrame([(dt.date(2999, 1, 1),), (dt.date(2000, 1, 1),)], "d date")
    assert [x[0] for x in df.select(valid_date("d")).collect()] == [None, dt.date(2000, 1, 1)]


def test_year_only_text_parses_in_spark(spark):
    # Spark reads '2020' as 2020-01-01 (DuckDB does not); kept out of oracle fixtures.
    df = spark.createDataFrame([("2020",)], "r string")
    assert df.select(safe_cast("r", "date")).first()[0] == dt.date(2020, 1, 1)
