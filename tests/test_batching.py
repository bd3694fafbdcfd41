import pandas as pd
import pytest
from pyspark.sql import functions as F

from shapeloom.operators import batching, consolidate, encoders

SCHEMA = "shape string, images bigint, task int"


@pytest.fixture(scope="module")
def rows(spark):
    shape = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string")))
    return spark.range(3000).select("id", shape.alias("shape"))


def describe(batch: pd.DataFrame) -> pd.DataFrame:
    from pyspark import TaskContext

    assert batch["shape"].nunique() == 1
    return pd.DataFrame({"shape": [batch["shape"].iloc[0]], "images": [len(batch)], "task": [TaskContext.get().partitionId()]})


def test_exact_batches_even_for_a_hot_shape(rows, settings):
    settings({"spark.sql.execution.arrow.maxRecordsPerBatch": "7"})
    chunked = batching.chunk_rows(rows, ["shape"], ["id"], 32)
    got = batching.apply_batches(chunked, ["shape"], describe, SCHEMA).collect()
    counts = {r.shape: r["count"] for r in rows.groupBy("shape").count().collect()}
    for shape, n in counts.items():
        sizes = sorted((r.images for r in got if r.shape == shape), reverse=True)
        assert sizes == [32] * (n // 32) + ([n % 32] if n % 32 else [])
    assert len({r.task for r in got if r.shape == "hot"}) > 1, "a hot shape must not sit in one task"


def test_local_batches_cover_every_row_once(rows, settings, plan):
    settings({"spark.sql.execution.arrow.maxRecordsPerBatch": "50"})
    out = batching.apply_local_batches(rows, ["shape"], describe, SCHEMA, 32)
    assert "Exchange" not in plan(out)
    got = out.collect()
    assert sum(r.images for r in got) == 3000
    assert max(r.images for r in got) <= 32
    short = [r for r in got if r.images < 32]
    assert len(short) <= len({(r.shape, r.task) for r in got})


def test_runs_continue_across_frames():
    frames = [pd.DataFrame({"k": k, "v": range(len(k))}) for k in (["a", "a"], ["a", "b"], [], ["b"], ["c"])]
    runs = list(batching.split_on_keys(iter(frames), ["k"]))
    assert [(r["k"].iloc[0], len(r)) for r in runs] == [("a", 3), ("b", 2), ("c", 1)]


def test_repeated_keys_keep_all_rows(spark):
    """Results travel with their row, so two images with one id both come out."""
    twice = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], "id int, shape string")

    def echo(batch):
        return batch[["id"]]

    assert sorted(r.id for r in batching.apply_local_batches(twice, ["shape"], echo, "id int", 2).collect()) == [1, 1, 2]


def test_spread_only_touches_small_scans(spark):
    assert batching.spread_rows(spark.range(0, 100, 1, 1), ["id"]).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 64)
    assert batching.spread_rows(wide, ["id"]) is wide


def test_later_maps_override_earlier_ones(spark):
    def mapping(pairs):
        return spark.createDataFrame(pairs, "image_id string, h int, w int")

    merged = consolidate.merge_ranked([mapping([("a", 1, 1), ("b", 2, 2)]), mapping([("b", 3, None)])], ["image_id"], ["h", "w"])
    assert sorted(map(tuple, merged.collect())) == [("a", 1, 1), ("b", 3, None)]


def test_caption_map_last_row_wins_whole(spark):
    rows = [("u", 1, "a1", "b1"), ("u", 2, "a2", None), ("v", 1, None, "b")]
    table = spark.createDataFrame(rows, "url_highres string, seq int, long string, brief string")
    caps = consolidate.caption_map(table, "url_highres", ["seq"], {"long": "cap_florence", "brief": "cap_florence_short"})
    got = {r.url: r.caps for r in caps.collect()}
    assert got == {
        "u": {"cap_florence": "a2", "cap_florence_short": None},
        "v": {"cap_florence": None, "cap_florence_short": "b"},
    }


def test_frames_see_their_worker_and_shared_state(spark):
    def tag(frame, worker, state):
        state.append(len(frame))
        return frame.assign(worker=worker, calls=len(state))

    df = spark.range(0, 100, 1, 4)
    out = batching.map_frames(df, tag, "id bigint, worker int, calls int", list).collect()
    assert len(out) == 100 and {r.worker for r in out} == {0, 1, 2, 3}


def test_models_load_once_per_worker_process(spark, tmp_path):
    def make_fn():
        import os
        import uuid

        (tmp_path / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return lambda texts: [[float(len(t))] for t in texts]

    df = spark.range(0, 400, 1, 40).select(F.col("id").cast("string").alias("t"))
    out = df.select(F.length("t").alias("n"), encoders.encode_texts(F.col("t"), make_fn, 7)[0].alias("v"))
    assert out.filter("n != v").count() == 0
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) < 40


def test_a_filter_on_a_model_result_does_not_run_it_again(spark, plan):
    vectors = spark.createDataFrame([([1.0, 2.0],)], "v array<float>")
    latent = encoders.encode_tensors(F.col("v"), encoders.projection_encoder(2, 3), 2)
    exploded = vectors.select(F.explode(latent).alias("x")).filter("x > -100")
    assert plan(exploded).count("ArrowEvalPython") == 1


def test_waiting_rows_are_bounded_by_bytes(spark):
    import pandas as pd

    from shapeloom.operators.batching import apply_local_batches

    rows = spark.range(400).selectExpr("id", "id % 7 AS shape", "repeat('x', 1000) AS payload").coalesce(1)

    def size(frame):
        return pd.DataFrame({"id": frame["id"], "n": len(frame)})

    def batches(limit):
        return {r.id: r.n for r in apply_local_batches(rows, ["shape"], size, "id long, n long", 100, limit).collect()}

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        free, bound = batches(1 << 30), batches(60_000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(free) == set(bound) == set(range(400))
    assert max(free.values()) > 50 and max(bound.values()) < 20
