"""Run log, counters and throughput."""

from __future__ import annotations

from pyspark.sql import functions as F

from shapeloom.functions.geometry import has_min_pixels
from shapeloom.functions.paths import swap_extension
from shapeloom.operators import intervals, ledger, metrics
from shapeloom.session import shared_dir, table
from shapeloom.streaming import intake, progress, rates
from shapeloom.workload import ORACLE, query
from shapeloom.workload.standins import LINE_IMAGES_SQL, line_images


@query(
    "run_counts",
    f"""WITH {LINE_IMAGES_SQL}
SELECT l_returnflag, count(*) AS total, count(*) FILTER (width * height >= 1048576) AS kept,
       count(*) FILTER (width * height < 1048576) AS skipped FROM line_images GROUP BY l_returnflag""",
)
def run_counts(spark, sf_dir):
    keep = has_min_pixels(F.col("width"), F.col("height"), 1024)
    return metrics.filter_counts(line_images(spark, sf_dir), keep, ["l_returnflag"])


HOURS_SQL = "hours AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS images FROM events GROUP BY ALL)"


def hourly(spark, sf_dir):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy("event_type", hour.alias("hour")).agg(F.count(F.lit(1)).alias("images"))


def day_block():
    return F.unix_date(F.to_date("hour")).cast("bigint")


@query(
    "rate_smoothed",
    f"""WITH {HOURS_SQL}, rated AS (SELECT *, images / 3600.0e0 AS rate FROM hours WHERE images > 0)
SELECT event_type, strftime(hour, '%Y-%m-%d %H') AS hour, images, round(avg(rate) OVER (PARTITION BY event_type ORDER BY hour
  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 9) AS smoothed_rate FROM rated""",
)
def rate_smoothed(spark, sf_dir):
    intervals = hourly(spark, sf_dir).withColumn("seconds", F.lit(3600.0))
    out = metrics.smoothed_rate(intervals, ["event_type"], ["hour"], "images", "seconds", day_block())
    hour = F.date_format("hour", "yyyy-MM-dd HH").alias("hour")
    return out.select("event_type", hour, "images", F.round("smoothed_rate", 9).alias("smoothed_rate"))


POLLS_SQL = """polls AS (SELECT event_type, epoch_us(ts) / 1e6 AS polled, count(*) AS n FROM events GROUP BY ALL),
walk AS (SELECT event_type, min(polled) AS polled FROM polls GROUP BY event_type
  UNION ALL SELECT w.event_type, min(p.polled) FROM walk w JOIN polls p ON p.event_type = w.event_type AND p.polled >= w.polled + 1800 GROUP BY w.event_type),
ends AS (SELECT event_type, polled, lag(polled) OVER (PARTITION BY event_type ORDER BY polled) AS since FROM walk),
merged AS (SELECT e.event_type, e.polled, sum(p.n)::BIGINT AS images, e.polled - e.since AS seconds
  FROM ends e JOIN polls p ON p.event_type = e.event_type AND p.polled > e.since AND p.polled <= e.polled GROUP BY ALL)"""


def event_polls(spark, sf_dir):
    """Every event is a poll of its type's run that brings one image."""
    polled = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return table(spark, sf_dir, "events").select("event_type", polled.alias("polled"), F.lit(1).alias("n"))


@query("polls_merged", f"WITH RECURSIVE {POLLS_SQL} SELECT event_type, polled, images, seconds FROM merged")
def polls_merged(spark, sf_dir):
    """Polls joined into intervals of at least half an hour, as the live rate joins them into half seconds."""
    merged = intervals.merge_polls(event_polls(spark, sf_dir), ["event_type"], "polled", "n", 1800.0)
    return merged.withColumnRenamed("n", "images")


@query(
    "rate_of_merged_polls",
    f"""WITH RECURSIVE {POLLS_SQL}
SELECT event_type, polled, round(avg(images / seconds) OVER (PARTITION BY event_type ORDER BY polled ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 9) AS smoothed_rate FROM merged""",
)
def rate_of_merged_polls(spark, sf_dir):
    """The live rate: polls merged, then the mean of the last five intervals."""
    merged = intervals.merge_polls(event_polls(spark, sf_dir), ["event_type"], "polled", "n", 1800.0)
    day = F.floor(F.col("polled") / 86400).cast("bigint")
    rated = metrics.smoothed_rate(merged, ["event_type"], ["polled"], "n", "seconds", day)
    return rated.select("event_type", "polled", F.round("smoothed_rate", 9).alias("smoothed_rate"))


@query(
    "rate_blended",
    f"""WITH {HOURS_SQL}, summed AS (
  SELECT *, sum(images) OVER (PARTITION BY event_type ORDER BY hour) / (epoch(hour - TIMESTAMP '2024-01-01') + 3600) AS overall FROM hours)
SELECT event_type, strftime(hour, '%Y-%m-%d %H') AS hour, round((overall + images / 3600.0e0) / 2, 9) AS blended_rate FROM summed""",
)
def rate_blended(spark, sf_dir):
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    polled = hourly(spark, sf_dir).withColumn("elapsed", F.unix_timestamp("hour") - start + 3600)
    out = metrics.blended_rate(polled, ["event_type"], ["hour"], "images", "elapsed", 3600.0, day_block())
    hour = F.date_format("hour", "yyyy-MM-dd HH").alias("hour")
    return out.select("event_type", hour, F.round("blended_rate", 9).alias("blended_rate"))


# Each customer is a run; its orders are its files, the finished ones marked 'F'.
ETA_SQL = """progress AS (
  SELECT o_custkey, count(*) AS files_total, count(*) FILTER (o_orderstatus = 'F') AS files_done,
         coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 + o_orderkey % 97 END), 0)::BIGINT AS images,
         (1 + o_custkey % 50) / 64.0e0 AS rate FROM orders GROUP BY o_custkey),
timed AS (SELECT *, CASE WHEN files_done > 0 THEN images / files_done::DOUBLE * (files_total - files_done) / rate END AS seconds FROM progress)"""


@query(
    "eta",
    f"""WITH {ETA_SQL}
SELECT o_custkey, files_done, files_total, images, round(seconds, 6) AS seconds, CASE
  WHEN seconds < 60 THEN floor(seconds + 0.5e0)::BIGINT || 's'
  WHEN seconds < 3600 THEN floor(seconds / 60 * 10 + 0.5e0)::BIGINT // 10 || '.' || floor(seconds / 60 * 10 + 0.5e0)::BIGINT % 10 || 'm'
  WHEN seconds IS NOT NULL THEN floor(seconds / 3600 * 10 + 0.5e0)::BIGINT // 10 || '.' || floor(seconds / 3600 * 10 + 0.5e0)::BIGINT % 10 || 'h' END AS eta
FROM timed""",
)
def eta(spark, sf_dir):
    done = F.col("o_orderstatus") == "F"
    runs = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(done).alias("files_done"),
        F.coalesce(F.sum(F.when(done, 1 + F.col("o_orderkey") % 97)), F.lit(0)).alias("images"),
    )
    rate = (1 + F.col("o_custkey") % 50) / F.lit(64.0)
    seconds = metrics.remaining_seconds(F.col("images"), F.col("files_done"), F.col("files_total"), rate)
    return runs.withColumn("s", seconds).select(
        "o_custkey", "files_done", "files_total", "images", F.round("s", 6).alias("seconds"), metrics.eta_text(F.col("s")).alias("eta")
    )


# Orders as shards: '<priority folder>/<key>.tar'; status says what became of them.
@query(
    "pending_files",
    """SELECT left(o_orderpriority, 1) || '/' || o_orderkey || '.tar' AS path FROM orders
WHERE o_orderstatus <> 'F' AND o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'""",
)
def pending_files(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    name = F.concat(F.left("o_orderpriority", F.lit(1)), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".tar"))
    listing = orders.withColumn("path", name)
    done = listing.filter("o_orderstatus = 'F'")
    outputs = listing.filter("o_orderstatus = 'P'").select(swap_extension(F.col("path"), ".tar", ".parquet").alias("output"))
    published = outputs.select(swap_extension(F.col("output"), ".parquet", ".tar").alias("path"))
    quarantined = listing.filter("o_orderpriority = '1-URGENT'")
    return ledger.pending_inputs(listing.select("path"), done, published, quarantined)


def order_log(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "O", "started").otherwise(F.lit("failed"))
    path = F.concat(F.lit("shard_"), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        path.alias("path"), status.alias("status"), (F.col("o_orderkey") % 3).cast("int").alias("attempt")
    )


LOG_SQL = """log AS (SELECT 'shard_' || o_custkey AS path, o_orderkey % 3 AS attempt,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'started' ELSE 'failed' END AS status FROM orders),
crashed AS (SELECT DISTINCT path, attempt FROM log WHERE status = 'started'
  EXCEPT SELECT path, attempt FROM log WHERE status IN ('finished', 'failed'))"""


@query("crashed_shards", f"WITH {LOG_SQL} SELECT path, attempt FROM crashed")
def crashed_shards(spark, sf_dir):
    return ledger.crashed_inputs(order_log(spark, sf_dir)).withColumn("attempt", F.col("attempt").cast("bigint"))


@query("quarantine_shards", f"WITH {LOG_SQL} SELECT path FROM log WHERE status = 'failed' UNION SELECT path FROM crashed")
def quarantine_shards(spark, sf_dir):
    return ledger.quarantine(order_log(spark, sf_dir))


# ---- streaming ---------------------------------------------------------------------


@query(
    "stream_throughput",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS window_start, event_type, count(*) AS images, round(count(*) / 3600.0e0, 9) AS rate
FROM events GROUP BY ALL""",
)
def stream_throughput(spark, sf_dir):
    """All hourly windows of the event stream, kept up to date by a watermarked streaming query."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out = shared_dir(spark, "throughput")
    counted = progress.throughput(events.select("ts", "event_type"), "ts", "1 hour", "1 hour", ["event_type"])
    progress.write_throughput(counted, f"{out}/rows", f"{out}/checkpoint")
    rows = progress.read_throughput(spark, f"{out}/rows", ["event_type"])
    start = F.date_format("window_start", "yyyy-MM-dd HH").alias("window_start")
    return rows.select(start, "event_type", "images", F.round("rate", 9).alias("rate"))


def _in_time_order(spark, sf_dir, folder, part, parts):
    """One of ``parts`` stretches of the events, added as a file of its own."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    ends = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    place = F.floor((F.unix_micros("ts") - ends[0]) * parts / F.lit(max(1, ends[1] - ends[0])))
    mine = events.where(F.least(place, F.lit(parts - 1)) == part)
    if part == parts - 1:  # a late last event of every run lets the watermark pass all others
        far = events.groupBy("event_type").agg(F.timestamp_micros(F.lit(ends[1] + 10 * 86_400_000_000)).alias("ts"))
        mine = mine.unionByName(far)
    mine.repartition(1).write.mode("append").parquet(folder)


def _streamed_rates(spark, sf_dir, rated):
    """The rates after two runs of the stream over the same checkpoint, several micro-batches each."""
    out = shared_dir(spark, "rates")
    for part in range(6):
        _in_time_order(spark, sf_dir, f"{out}/in", part, 6)
        if part in (2, 5):
            events = spark.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
            rates.write_rates(rated(events), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


@query("stream_rate", ORACLE["rate_smoothed"])
def stream_rate(spark, sf_dir):
    """The hourly smoothed rate from a stream that is stopped and taken up again: closed windows feed the state of each run."""

    def rated(events):
        marked = events.withWatermark("ts", "1 hour")
        counted = marked.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
        hours = counted.select("event_type", F.window_time("window").alias("ended"), "n")
        return rates.stream_rates(hours, ["event_type"], "ended", "n", late_by=None, seconds=3600.0)

    found = _streamed_rates(spark, sf_dir, rated)
    hour = F.date_format(F.timestamp_micros((F.col("at") * 1e6).cast("bigint")), "yyyy-MM-dd HH").alias("hour")
    return found.select("event_type", hour, "images", F.round("smoothed_rate", 9).alias("smoothed_rate"))


@query("stream_rate_of_polls", ORACLE["rate_of_merged_polls"])
def stream_rate_of_polls(spark, sf_dir):
    """The rate of merged polls from a stream that is stopped and taken up again."""

    def rated(events):
        return rates.stream_rates(events.withColumn("n", F.lit(1)), ["event_type"], "ts", "n", "1 hour", 1800.0)

    found = _streamed_rates(spark, sf_dir, rated)
    return found.select("event_type", F.col("at").alias("polled"), F.round("smoothed_rate", 9).alias("smoothed_rate"))


@query("stream_progress", "SELECT count(*) AS input_rows, 12::BIGINT AS batches, 0::BIGINT AS late_rows FROM events")
def stream_progress(spark, sf_dir):
    """What the listener recorded of a stream over the events in twelve files, one per micro-batch."""
    out = shared_dir(spark, "progress")
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    events.repartition(12).write.parquet(f"{out}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    counted = progress.throughput(stream, "ts", "1 hour", "400 days", ["event_type"])
    progress.write_throughput(counted, f"{out}/rows", f"{out}/checkpoint")
    seen = progress.read_progress(spark, f"{out}/checkpoint-progress")
    return seen.agg(F.sum("input_rows").alias("input_rows"), F.count_if(F.col("input_rows") > 0).alias("batches"), F.sum("late_rows").alias("late_rows"))


def _order_files(spark, sf_dir, out):
    """The orders as several input files, so that intake is spread over micro-batches."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.repartition(6, "o_orderkey").write.parquet(f"{out}/in")
    return orders.schema


@query("stream_bounded", "SELECT o_orderkey, o_orderstatus FROM orders")
def stream_bounded(spark, sf_dir):
    """Two files per micro-batch; every order comes out once."""
    out = shared_dir(spark, "bounded")
    schema = _order_files(spark, sf_dir, out)
    stream = intake.stream_files(spark, f"{out}/in", schema, max_files=2)
    intake.run_intake(stream, lambda b: b.select("o_orderkey", "o_orderstatus"), f"{out}/rows", f"{out}/log", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows").select("o_orderkey", "o_orderstatus")


@query("ledger_resume", "SELECT o_orderstatus, count(*) AS images, 0::BIGINT AS second_run_batches FROM orders GROUP BY o_orderstatus")
def ledger_resume(spark, sf_dir):
    """Running the intake again takes nothing and adds nothing."""
    out = shared_dir(spark, "resume")
    schema = _order_files(spark, sf_dir, out)
    batches = []
    for _ in range(2):
        stream = intake.stream_files(spark, f"{out}/in", schema, max_files=3)
        batches.append(intake.run_intake(stream, lambda b: b.drop("source_file"), f"{out}/rows", f"{out}/log", f"{out}/checkpoint"))
    rows = ledger.read_committed(spark, f"{out}/rows", ledger.read_log(spark, f"{out}/log"))
    counted = rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("images"))
    return counted.withColumn("second_run_batches", F.lit(batches[1]).cast("bigint"))
