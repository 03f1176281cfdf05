"""Time buckets are wall-clock buckets of timestamp_ntz values: the session
time zone must not move them."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerwatch.functions.scalar import bucket_start


def test_bucket_start_ignores_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    seen = []
    try:
        for tz in ["UTC", "Asia/Kolkata", "America/New_York"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = (spark.createDataFrame([("2024-01-15 10:47:13",), ("1969-12-31 23:59:59",)], "s string")
                  .select(F.col("s").cast("timestamp_ntz").alias("ts")))
            seen.append([tuple(r) for r in df.select(bucket_start("ts", 3600), bucket_start("ts", 86400),
                                                     bucket_start("ts", 300)).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(s == seen[0] for s in seen)
    assert seen[0][0] == (dt.datetime(2024, 1, 15, 10), dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15, 10, 45))
    assert seen[0][1] == (dt.datetime(1969, 12, 31, 23), dt.datetime(1969, 12, 31), dt.datetime(1969, 12, 31, 23, 55))
