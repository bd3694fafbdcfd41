"""Large shards are walked by several tasks, filters reach the source, shards come as a stream."""

import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringEndsWith, StringStartsWith

from shapeloom.sources import tar, tar_ranges
from shapeloom.streaming import intake


def archive(members, fmt=tarfile.GNU_FORMAT):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=fmt) as made:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            made.addfile(info, io.BytesIO(data))
    return out.getvalue()


def plain(n, size=900, prefix="m"):
    return [(f"{prefix}{i}.json" if i % 2 else f"{prefix}{i}.jpg", json.dumps({"k": i}).encode() if i % 2 else bytes([i % 256]) * (size * (1 + i % 5))) for i in range(n)]


NESTED = archive(plain(300, prefix="inner"))
UNENDED = NESTED[: NESTED.rstrip(b"\0").__len__() // 512 * 512 + 512]
SHARDS = {
    "plain.tar": archive(plain(400)),
    "long-names.tar": archive([("d" * 150 + "/" + n, d) for n, d in plain(200)]),
    "pax.tar": archive([("é" * 120 + n, d) for n, d in plain(200)], tarfile.PAX_FORMAT),
    "nested.tar": archive([*plain(50), ("inside.tar", NESTED), *plain(50, prefix="z")]),
    "nested-without-end.tar": archive([*plain(20), ("inside.tar", UNENDED), *plain(90, prefix="z")]),
    "one-large.tar": archive([("big.bin", b"x" * 400_000), *plain(20)]),
    "cut.tar": archive(plain(300))[:200_000],
    "damaged.tar": (lambda d: d[:150_000 // 512 * 512] + b"\xff" * 512 + d[150_000 // 512 * 512 + 512 :])(archive(plain(300, size=100))),
    "empty.tar": archive([]),
}


@pytest.fixture
def folder(tmp_path):
    for name, data in SHARDS.items():
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def test_ranges_give_the_sequential_walk(spark, folder):
    whole = [tuple(r) for r in tar.scan_tar(spark, folder).collect()]
    for size in (1 << 15, 100_000):
        cut = [tuple(r) for r in tar.scan_tar(spark, folder, range_bytes=size).collect()]
        assert len(cut) == len(whole) and set(cut) == set(whole)
    large = [(n, len(d)) for n, d in SHARDS.items() if len(d) > 1 << 14]
    planned = tar_ranges.plan_ranges(spark, folder, large, 1 << 14)
    assert len(planned["plain.tar"]) > 20 and len(planned["nested.tar"]) > 10 and len(planned["one-large.tar"]) <= 5


def test_headers_inside_a_payload_are_rejected():
    data = SHARDS["nested.tar"]
    begin = data.index(b"inside.tar") + 512 * 20
    entry, onto = tar_ranges.guess(io.BytesIO(data), begin, len(data), len(data))
    outer = {m.offset for m in tarfile.open(fileobj=io.BytesIO(data))}
    assert entry in outer and onto == len(data)


class Counted(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        out = super().read(size)
        Counted.taken += len(out)
        return out


def test_filters_decide_what_is_opened_and_read(folder, monkeypatch):
    opened = []

    def open_counted(path, window=0):
        opened.append(path.rsplit("/", 1)[1])
        with open(path, "rb") as file:
            return Counted(file.read())

    def read(filters):
        opened.clear()
        Counted.taken = 0
        reader = tar.TarMemberReader(None, {"path": folder})
        left = list(reader.pushFilters(filters))
        rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        return rows, left, list(opened), Counted.taken

    monkeypatch.setattr(tar, "open_shard", open_counted)
    everything, left, all_opened, bytes_all = read([])
    assert len(all_opened) == len(SHARDS) and not left
    rows, left, only, _ = read([IsNotNull(("shard",)), EqualTo(("shard",), "plain.tar")])
    assert only == ["plain.tar"] and not left and rows == [r for r in everything if r["shard"] == "plain.tar"]
    _, left, some, _ = read([In(("shard",), ("plain.tar", "pax.tar", "absent.tar")), GreaterThan(("size",), 5)])
    assert sorted(some) == ["pax.tar", "plain.tar"] and left == [GreaterThan(("size",), 5)]
    rows, left, _, bytes_some = read([IsNotNull(("member",)), StringStartsWith(("member",), "z"), StringEndsWith(("member",), ".jpg")])
    assert not left and rows == [r for r in everything if (r["member"] or "").startswith("z") and r["member"].endswith(".jpg")]
    assert bytes_some < bytes_all


def test_the_plan_shows_the_filters(spark, folder, capsys):
    rows = tar.scan_tar(spark, folder).filter((F.col("shard") == "plain.tar") & F.col("member").endswith(".json"))
    rows.explain("formatted")
    text = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(shard), IsNotNull(member), EqualTo(shard,plain.tar), StringEndsWith(member,.json)]" in text
    assert "Filter (" not in text, "nothing is left to filter"
    assert rows.count() == 200


def test_shards_as_a_stream_with_a_restart(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)

    def take():
        intake.take_shards(spark, f"{tmp_path}/in", lambda m: m.select("shard", "member"), f"{tmp_path}/out", f"{tmp_path}/mark", max_shards=2)

    names = ["c.tar", "sub/d.tar", "e.tar", "a.tar", "sub/b.tar"]
    for i, name in enumerate(names):
        (tmp_path / "in" / name).write_bytes(archive(plain(5, prefix=f"s{i}-")))
        if i in (2, 4):
            take()
    take()
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(rows) == len(set(rows)) == 25 and {r[0] for r in rows} == set(names)
    assert len(list((tmp_path / "mark-shards").iterdir())) == 3
