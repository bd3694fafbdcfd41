"""Runs that pause on a stream."""

import datetime as dt

from shapeloom.streaming import rates

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_a_run_that_paused_goes_on_beside_a_late_end(spark, tmp_path):
    """The last polls come with one that the watermark does not pass; each is closed once it is passed itself."""
    far = [(run, 86_400, 0) for run in "aq"]
    files = [[("a", t, 1) for t in range(11)] + [("q", t, 1) for t in range(4)], [("a", t, 1) for t in range(11, 31)], [("q", t, 2) for t in (31, 33, 35)] + far]
    for rows in files:
        stamped = [(run, START + dt.timedelta(seconds=t), n) for run, t, n in rows]
        spark.createDataFrame(stamped, "run string, ts timestamp, n bigint").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("run string, ts timestamp, n bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    rates.write_rates(rates.stream_rates(stream, ["run"], "ts", "n", "5 seconds", 2.0), f"{tmp_path}/out", f"{tmp_path}/mark")
    got = [(r.at - START.timestamp(), r.images) for r in spark.read.parquet(f"{tmp_path}/out").where("run = 'q'").orderBy("at").collect()]
    assert got == [(2.0, 2), (31.0, 3), (33.0, 2), (35.0, 2)]
