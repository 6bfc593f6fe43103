import datetime as dt

from pyspark.sql import functions as F

from velolake.functions.time import calendar_parts, epoch_ms_to_ts


def test_epoch_ms_to_whole_seconds(spark):
    cases = [1711425045123, 1711425045999, 0, -1, -1500, None, 253402300800000, 9000000000000000000]
    df = spark.createDataFrame([(c,) for c in cases], "timestamp long")
    # Python datetimes stop at year 9999, so compare epoch seconds
    got = [r[0] for r in df.select(F.unix_seconds(epoch_ms_to_ts("timestamp"))).collect()]
    assert got[0] == got[1] == 1711425045                     # milliseconds dropped
    assert dt.datetime.fromtimestamp(got[0], dt.timezone.utc).hour == 3
    assert got[2] == 0
    assert got[3] == 0                                        # -1 ms -> 0 s (toward zero)
    assert got[4] == -1                                       # -1500 ms -> -1 s
    assert got[5] is None
    assert got[6] == 253402300800
    assert got[7] is None                                     # out of range -> NULL, no error
    year = df.select(F.year(epoch_ms_to_ts("timestamp"))).collect()[6][0]
    assert year == 10000


def test_calendar_parts_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 10, 0),)], "h timestamp_ntz") \
        .select(F.col("h").cast("timestamp").alias("h"))
    r = df.select(*calendar_parts("h")).first()
    assert (r.year, r.month, r.day, r.day_of_week, r.hour) == (2024, 1, 7, 1, 10)


def test_epochs_that_no_timestamp_holds_are_counted(spark):
    from velolake.operators import gold
    df = spark.createDataFrame([(0,), (10 ** 18,), (-10 ** 18,), (None,), (1711425045123,)], "timestamp long")
    assert tuple(gold.epoch_rejects(df).first()) == (2, 5)
