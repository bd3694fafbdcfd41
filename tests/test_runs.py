import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shapeloom.functions import captions as cap
from shapeloom.functions import paths
from shapeloom.operators import ledger, metrics
from shapeloom.sinks import writers
from shapeloom.sources import catalog
from shapeloom.sources.tar import list_inputs
from shapeloom.streaming import intake, progress


def test_inputs_are_told_apart_by_full_path(spark):
    listing = spark.createDataFrame([("0/a/00001.parquet",), ("1/a/00001.parquet",)], "path string")
    done = spark.createDataFrame([("0/a/00001.parquet",), ("0/a/00001.parquet",)], "path string")
    assert [r.path for r in ledger.pending_inputs(listing, done).collect()] == ["1/a/00001.parquet"]


def test_log_crash_quarantine_and_commit(spark, tmp_path):
    log = str(tmp_path / "log")
    assert ledger.read_log(spark, log).count() == 0
    rows = [("a", "started", 1), ("a", "finished", 1), ("b", "started", 1), ("c", "started", 1), ("c", "failed", 1)]
    rows += [("d", "started", 1), ("d", "empty", 1), ("b", "started", 2), ("b", "finished", 2)]
    ledger.append_log(spark.createDataFrame(rows, "path string, status string, attempt int").withColumn("run", F.lit("r-1")), log)
    entries = ledger.read_log(spark, log)
    assert entries.count() == len(rows)
    assert [tuple(r) for r in ledger.crashed_inputs(entries).collect()] == [("b", 1)]
    assert sorted(r.path for r in ledger.quarantine(entries).collect()) == ["b", "c"]

    data = str(tmp_path / "data")
    spark.range(3).withColumn("run", F.lit("r-1")).write.partitionBy("run").mode("append").parquet(data)
    spark.range(5).withColumn("run", F.lit("r-2")).write.partitionBy("run").mode("append").parquet(data)
    assert ledger.read_committed(spark, data, entries).count() == 3, "output of an unlogged run must stay invisible"


def test_shard_status(spark):
    rows = spark.createDataFrame([("s1", None), ("s1", "bad"), ("s2", None)], "shard string, error string")
    got = {r.shard: (r.good, r.bad, r.status, r.error) for r in ledger.shard_status(rows).collect()}
    assert got == {"s1": (1, 1, "failed", "bad"), "s2": (1, 0, "finished", None)}


def test_counts_while_filtering(spark):
    seen = Observation("filter")
    kept = metrics.observe_filter(spark.range(100), F.col("id") % 4 == 0, seen)
    assert kept.count() == 25
    assert seen.get == {"total": 100, "kept": 25, "skipped": 75}


@pytest.mark.parametrize(
    ("seconds", "text"),
    [(0.0, "0s"), (59.4, "59s"), (60.0, "1.0m"), (90.0, "1.5m"), (3599.0, "60.0m"), (3600.0, "1.0h"), (9000.0, "2.5h"), (360000.0, "100.0h")],
)
def test_eta_text(spark, seconds, text):
    assert spark.range(1).select(metrics.eta_text(F.lit(seconds)).alias("t")).first().t == text


def test_eta_without_progress(spark):
    df = spark.createDataFrame([(10, 2, 6, 2.0), (10, 2, 6, 0.0), (0, 0, 6, 1.0)], "i int, d int, t int, r double")
    got = [r.s for r in df.select(metrics.remaining_seconds(*[F.col(c) for c in "idtr"]).alias("s")).collect()]
    assert got == [10.0, 0.0, None]


def test_idle_intervals_are_skipped_but_elapse(spark):
    rows = [(t, n, float(t + 1)) for t, n in enumerate([4, 0, 8, 0, 0, 2, 6, 10, 12])]
    ticks = spark.createDataFrame(rows, "t int, images bigint, elapsed double").withColumn("one", F.lit(1.0))
    smooth = metrics.smoothed_rate(ticks, [], ["t"], "images", "one", F.lit(0).cast("bigint")).orderBy("t").collect()
    assert [(r.t, r.smoothed_rate) for r in smooth][-1] == (8, (8 + 2 + 6 + 10 + 12) / 5)
    blend = metrics.blended_rate(ticks, [], ["t"], "images", "elapsed", 1.0, F.lit(0).cast("bigint")).orderBy("t").collect()
    assert [r.blended_rate for r in blend][:3] == [4.0, 2.0, (12 / 3 + 8) / 2]


def test_sidecar_edge_cases(spark):
    docs = [
        '{"key": "k", "url": "u"}', '{"key": "k", "caption": null}', '{"key": 12, "caption": ""}', '{"key": {"a": 1}}',
        '[1, 2]', '"text"', "{broken", "", None, ' \n{"key": "k"}',
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    got = {r.i: (r.valid, r.key, r.caption) for r in cap.with_sidecar(df, "doc").collect()}
    assert got[0] == (True, "k", "")
    assert got[1] == (True, "k", None)
    assert got[2] == (True, "12", "")
    assert got[3] == (True, '{"a":1}', "")
    assert all(got[i] == (False, None, None) for i in (4, 5, 6, 7, 8))
    assert got[9] == (True, "k", "")


def test_paths(spark):
    names = ["a/b.c.jpg", ".hidden.json", "x.JPG", "plain", "d.tar/e.json", "s/.json"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    p = F.col("p")
    rows = df.select("p", paths.stem(p).alias("s"), paths.is_image_member(p).alias("i"), paths.is_sidecar_member(p).alias("j")).collect()
    assert [(r.s, r.i, r.j) for r in rows] == [
        ("b", True, False), ("", False, False), ("x", False, False), ("plain", False, False), ("e", False, True), ("", False, False),
    ]
    swap = df.select(paths.swap_extension(F.lit("a.tar.b/x.tar"), ".tar", ".parquet").alias("s")).first().s
    assert swap == "a.tar.b/x.parquet"


# ---- sinks ---------------------------------------------------------------------------


def test_a_hot_resolution_is_written_by_several_tasks(spark, settings, tmp_path):
    settings({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"})
    body = F.sha2(F.col("id").cast("string"), 512)
    rows = spark.range(0, 20000, 1, 8).select("id", body.alias("latent"), F.when(F.col("id") % 3 > 0, "256x256").otherwise("512x128").alias("resolution"))
    out = str(tmp_path / "out")
    writers.write_by_resolution(rows, out)
    assert len(list((tmp_path / "out" / "resolution=256x256").glob("*.parquet"))) > 3
    assert spark.read.parquet(out).count() == 20000


def test_rows_per_file(spark, tmp_path):
    writers.write_rolled(spark.range(0, 1000, 1, 1), str(tmp_path / "out"), 300)
    counts = spark.read.parquet(str(tmp_path / "out")).groupBy(F.col("_metadata.file_path")).count()
    assert sorted(r["count"] for r in counts.collect()) == [100, 300, 300, 300]


def test_rewriting_a_shard_leaves_the_others(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(10).select("id", (F.col("id") % 2).cast("string").alias("part"), F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("shard"))
    writers.write_by_shard(rows, out)
    writers.write_by_shard(rows.filter("shard = 's1'").limit(2), out)
    got = {r.shard: r["count"] for r in spark.read.parquet(out).groupBy("shard").count().collect()}
    assert got == {"s0": 5, "s1": 2}


def test_json_entries_keep_nulls_and_text(spark):
    rows = spark.createDataFrame([("a", 'q"uo\nte é'), ("b", None)], "k string, v string")
    got = [r.value for r in writers.as_json_entries(rows, "k", "v").collect()]
    assert got == ['{"a":"q\\"uo\\nte é"}', '{"b":null}']


# ---- sources -------------------------------------------------------------------------


def test_catalog_scan_reads_only_what_is_asked(spark, tmp_path, plan):
    for top in ("0", "1"):
        for aspect in ("1-1", "1-2"):
            folder = tmp_path / "cat" / top / "least_dim_range=256-512" / f"aspect_ratio_bucket={aspect}"
            spark.range(5).select(F.col("id").alias("key"), F.lit("x").alias("jpg"), F.lit("c").alias("caption")).coalesce(1).write.parquet(str(folder))
    rows = catalog.scan_catalog(spark, str(tmp_path / "cat"), ["0", "1"], ["key"])
    assert "ReadSchema: struct<key:bigint,_tmp_metadata_row_index:bigint>" in plan(rows)
    assert rows.count() == 20
    assert rows.select("source_file").distinct().count() == 4
    regrouped = catalog.regroup(rows, "aspect_ratio_bucket")
    assert {r.aspect_ratio_bucket: r["count"] for r in regrouped.groupBy("aspect_ratio_bucket").count().collect()} == {"1-1": 10, "1-2": 10}
    filtered = catalog.scan_catalog(spark, str(tmp_path / "cat"), ["0"], ["key"]).filter("key > 3")
    assert "GreaterThan(key,3)" in plan(filtered)
    assert filtered.first().source_row == 4


def test_odd_file_names_round_trip(spark, tmp_path):
    root = tmp_path / "odd root+%41"
    names = ["plain.parquet", "a b.parquet", "c+d.parquet", "e%20f.parquet", "g%h.parquet", "é=1/x.parquet"]
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "one"))
    content = next((tmp_path / "one").glob("*.parquet")).read_bytes()
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    listed = sorted(r.path for r in list_inputs(spark, str(root), "*.parquet").collect())
    assert listed == sorted(names)
    rows = catalog.scan_catalog(spark, str(root), listed, ["id"])
    assert sorted({r.source_file for r in rows.collect()}) == sorted(names) and rows.count() == 18


def test_caption_dictionaries(spark, tmp_path):
    (tmp_path / "flat.json").write_text('{"a": "one",\n "b": null}')
    (tmp_path / "nested.json").write_text('{"a": {"caption": "one"}}')
    flat = catalog.load_caption_map(spark, str(tmp_path / "flat.json"), key="image_id")
    assert sorted(map(tuple, flat.collect()), key=str) == [("a", "one"), ("b", None)]
    nested = catalog.convert_caption_map(spark, str(tmp_path / "nested.json"), str(tmp_path / "pq"), "struct<caption:string>")
    assert nested.first().caption.caption == "one"


# ---- streaming -------------------------------------------------------------------------


def test_intake_is_bounded_and_resumes(spark, tmp_path):
    source, out, log, mark = (str(tmp_path / n) for n in ("in", "out", "log", "mark"))
    spark.range(0, 80, 1, 8).write.parquet(source)

    def take(max_files):
        stream = intake.stream_files(spark, source, "id bigint", max_files)
        return intake.run_intake(stream, lambda b: b.select("id"), out, log, mark)

    assert take(3) == 3
    assert take(3) == 0
    spark.range(80, 90, 1, 1).write.mode("append").parquet(source)
    assert take(3) == 1
    done = ledger.read_log(spark, log)
    assert done.count() == done.select("path").distinct().count() == 9
    assert sorted(r.id for r in ledger.read_committed(spark, out, done).collect()) == list(range(90))


def test_replayed_batch_replaces_its_output(spark, tmp_path):
    """Losing the checkpoint replays batch 0; its folder is overwritten, not added to."""
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    spark.range(0, 20, 1, 2).write.parquet(source)
    for attempt in range(2):
        stream = intake.stream_files(spark, source, "id bigint", 10)
        intake.run_intake(stream, lambda b: b.select("id"), out, log, str(tmp_path / f"mark{attempt}"))
    assert ledger.read_committed(spark, out, ledger.read_log(spark, log)).count() == 20


def test_throughput_of_a_table(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=7 * i), "view") for i in range(20)]
    out = progress.throughput(spark.createDataFrame(rows, "ts timestamp_ntz, kind string"), "ts", "1 hour", "1 hour", ["kind"])
    got = sorted((r.window_start.hour, r.images) for r in out.collect())
    assert got == [(0, 9), (1, 9), (2, 2)]
