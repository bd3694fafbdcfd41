"""How many files a tar job writes and how many tasks list them."""

import io
import json
import tarfile
from collections import Counter

from pyspark.sql import functions as F

from shapeloom.functions.buckets import BucketGrid
from shapeloom.operators import ledger
from shapeloom.operators.encoders import block_mean_encoder
from shapeloom.plans.jobs import ImageSettings, prepare_tar, read_rejects
from shapeloom.sources.files import list_files
from shapeloom.workload.standins import draw, open_png, png_bytes

SETTINGS = ImageSettings(block_mean_encoder(8), BucketGrid(32, 8, 16, 64), open_png)


def write_shard(path, first):
    """40 pictures: one in four with a sidecar, one in five damaged."""
    with tarfile.open(path, "w") as archive:
        for n in range(first, first + 40):
            members = [(f"{n}.jpg", png_bytes(draw(n, 32, 32, 3))[: 60 if n % 5 == 0 else None])]
            if n % 4 == 0:
                members.append((f"{n}.json", json.dumps({"key": str(n), "caption": "c"}).encode()))
            for name, data in members:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                archive.addfile(info, io.BytesIO(data))


def test_rejects_are_written_with_their_shard(spark, tmp_path, settings):
    """However the pairing dealt them out: a file, or two where a task ends inside the shard."""
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    (tmp_path / "in").mkdir()
    for shard in range(8):
        write_shard(tmp_path / "in" / f"s{shard}.tar", 40 * shard)
    work = str(tmp_path / "work")
    rows = prepare_tar(spark, str(tmp_path / "in"), work, "r", SETTINGS)
    assert {r.image_id for r in rows.select("image_id").collect()} == {str(n) for n in range(0, 320, 4) if n % 5}
    reasons = Counter(r.error if "sidecar" in r.error else "damaged" for r in read_rejects(spark, work).collect())
    assert reasons == {"image without a sidecar": 240, "damaged": 16}
    assert read_rejects(spark, work).where("resolution IS NOT NULL AND error = 'image without a sidecar'").isEmpty()
    files = list_files(f"{work}/data", ".parquet")
    assert len([f for f in files if "outcome=rejected" in f]) <= 8 + 3, "eight shards, four tasks"
    assert len([f for f in files if "outcome=ok" in f]) <= 8 + 3


def test_committed_rows_are_listed_by_few_tasks(spark, tmp_path):
    data, log = str(tmp_path / "data"), str(tmp_path / "log")
    rows = spark.range(0, 600, 1, 1).withColumns({"outcome": F.when(F.col("id") % 2 == 0, "ok").otherwise("rejected"), "shard": F.concat(F.lit("s"), F.floor(F.col("id") / 4))})
    for run in ("a:1", "dead"):
        rows.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run", "outcome", "shard").parquet(data)
    ledger.append_log(spark.createDataFrame([("p", ledger.FINISHED, "a:1")], "path string, status string, run string"), log)
    entries = ledger.read_log(spark, log)
    spark.sparkContext.setJobGroup("listing", "listing")
    got = ledger.read_committed(spark, data, entries, "outcome=rejected")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= 16, "150 folders"
    assert all("run=a%253A1/outcome=rejected" in f or "run=a%3A1/outcome=rejected" in f for f in got.inputFiles() if "run=" in f)
    assert sorted(r.id for r in got.collect()) == list(range(1, 600, 2)) and set(got.columns) == {"id", "run", "outcome", "shard"}
    none = ledger.read_committed(spark, data, entries, "outcome=other").where("outcome = 'other'")
    assert none.isEmpty() and set(none.columns) == set(got.columns)
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"
