"""Small shards share a task."""

import io
import tarfile

from shapeloom.sources import tar


def test_groups_keep_every_stretch_once():
    names = ["a.tar", "big.tar", "b.tar", "c.tar.gz", "absent.tar"]
    sizes = {"a.tar": 40, "big.tar": 900, "b.tar": 60, "c.tar.gz": 100}
    groups = tar.group_shards(names, sizes, {"big.tar": [[0, 500], [512, None]]}, 11)
    assert groups == [[["big.tar", 0, 500]], [["big.tar", 512, None]], [["a.tar", 0, None], ["b.tar", 0, None]], [["c.tar.gz", 0, None], ["absent.tar", 0, None]]]
    assert tar.group_shards([], {}, {}, 4) == []


def test_many_small_shards_take_few_tasks(spark, tmp_path):
    for n in range(200):
        with tarfile.open(tmp_path / f"s{n}.tar", "w") as archive:
            info = tarfile.TarInfo(f"{n}.json")
            info.size = 2
            archive.addfile(info, io.BytesIO(b"{}"))
    rows = tar.scan_tar(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() <= 2 * tar.TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    assert {(r.shard, r.member, r.content) for r in rows.collect()} == {(f"s{n}.tar", f"{n}.json", "{}") for n in range(200)}
    assert rows.where("shard = 's7.tar'").select("member").collect()[0].member == "7.json"
