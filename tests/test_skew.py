import pytest
from pyspark.sql import functions as F

from shapeloom.operators import joins, ordered, skew


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key, a tenth have none."""
    key = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
    return spark.range(12000).select(F.col("id"), key.alias("key"))


@pytest.fixture(scope="module")
def lookup(spark):
    keys = spark.range(650).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    return keys.union(spark.createDataFrame([("hot",)], "key string")).withColumn("value", F.upper("key"))


def as_bag(df):
    return sorted(map(str, df.select("id", "key", "value").collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(settings, plan, facts, lookup, how):
    expected = as_bag(facts.join(lookup, "key", how))
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    joined = skew.lookup_join(facts, lookup, ["key"], ["id"], how)
    assert "join_salt" in plan(joined)
    assert as_bag(joined) == expected


def test_small_lookup_is_joined_without_salting(spark, plan, facts, lookup, tmp_path):
    lookup.write.parquet(str(tmp_path / "lookup"))
    stored = spark.read.parquet(str(tmp_path / "lookup"))
    assert skew.estimated_bytes(stored) < skew.broadcast_limit(stored)
    joined = skew.lookup_join(facts, stored, ["key"], ["id"])
    assert "join_salt" not in plan(joined) and "BroadcastHashJoin" in plan(joined)


def test_hot_rows_spread_over_tasks(settings, facts, lookup):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"})

    def largest(df):
        return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

    assert largest(facts.join(lookup, "key", "left")) > 3500
    assert largest(skew.lookup_join(facts, lookup, ["key"], ["id"])) < 2500


def test_default_spread_leaves_keys_and_bytes_out(facts):
    wide = facts.withColumn("bytes", F.lit(b"x")).withColumn("list", F.array("id"))
    assert skew.spread_columns(wide, ["key"]) == ["id"]
    assert skew.spread_columns(wide.select("key"), ["key"]) == ["key"]


def test_hot_keys_are_bounded(facts):
    hot = skew.hot_keys(facts, ["key"], share=1 / 8)
    assert [r.key for r in hot.collect()] == ["hot"]
    assert skew.hot_keys(facts, ["key"], share=1 / 1000).count() < 1000


def test_missing_required_caption(spark, facts, lookup):
    caps = lookup.withColumnRenamed("value", "caption")
    known = facts.filter("key in ('hot', 'k1')")
    assert joins.required_captions(known, caps, "key").count() == known.count()
    with pytest.raises(Exception, match="no caption for key"):
        joins.required_captions(facts, caps, "key").collect()
    everything = joins.required_captions(facts, caps, "key", on_missing="null")
    assert everything.count() == 12000
    dropped = joins.required_captions(facts, caps, "key", on_missing="drop")
    assert dropped.count() == everything.filter("caption is not null").count()


def test_null_caption_counts_as_found(spark):
    images = spark.createDataFrame([("a",)], "image_id string")
    caps = spark.createDataFrame([("a", None)], "image_id string, caption string")
    assert joins.required_captions(images, caps).first().caption is None


@pytest.fixture(scope="module")
def grouped(spark):
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 0, None).otherwise((F.col("id") % 11).cast("string"))
    return spark.range(5000).select("id", group.alias("g"), ((F.col("id") * 37) % 101).alias("v"))


@pytest.mark.parametrize("blocks", ["range", "hash"])
def test_blocked_numbering(grouped, blocks):
    block = ordered.range_block("id", 64) if blocks == "range" else ordered.hash_block(["id"], 13)
    rows = ordered.number_rows(grouped, ["g"], ["id"], block).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r.g, []).append((r.row_number, r.id))
    assert sum(map(len, seen.values())) == 5000
    for pairs in seen.values():
        assert sorted(n for n, _ in pairs) == list(range(1, len(pairs) + 1))
        if blocks == "range":
            assert [i for _, i in sorted(pairs)] == sorted(i for _, i in pairs)


def test_no_task_numbers_a_whole_hot_group(grouped):
    """Sort-and-window work happens inside (group, block): at most 64 rows each."""
    cut = ordered._cut(grouped, ["g"], ordered.range_block("id", 64))
    assert cut.groupBy("block_key").count().agg(F.max("count")).first()[0] <= 64


def test_running_sum_and_rolling_mean(grouped):
    block = ordered.range_block("id", 50)
    sums = ordered.running_sum(grouped, ["g"], ["id"], "v", block, "s").collect()
    means = ordered.rolling_mean(grouped, ["g"], ["id"], "v", 5, "m", block, piece=7).collect()
    assert len(sums) == len(means) == 5000
    by_group = {}
    for r in sorted(grouped.collect(), key=lambda r: r.id):
        by_group.setdefault(r.g, []).append(r)
    total = {r.id: r.s for r in sums}
    mean = {r.id: r.m for r in means}
    for rows in by_group.values():
        running = 0
        for n, r in enumerate(rows):
            running += r.v
            window = [x.v for x in rows[max(0, n - 4) : n + 1]]
            assert total[r.id] == running
            assert mean[r.id] == pytest.approx(sum(window) / len(window))
