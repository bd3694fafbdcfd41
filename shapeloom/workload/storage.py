"""Sources and sinks: written to the shared folder and read back."""

from __future__ import annotations

import io
import tarfile

import pandas as pd
from pyspark.sql import functions as F

from shapeloom.functions.buckets import GRID_1024, assign_bucket
from shapeloom.functions.image_header import add_dimensions
from shapeloom.operators.batching import split_on_keys
from shapeloom.session import shared_dir, table
from shapeloom.sinks import writers
from shapeloom.sources import catalog, tar
from shapeloom.sources.files import resolve
from shapeloom.streaming import intake
from shapeloom.workload import query
from shapeloom.workload.geometry import DOC_BUCKETED
from shapeloom.workload.standins import LINE_IMAGES_SQL, PICTURES_SQL, doc_images, line_images, pictures


@query("scan_catalog", "SELECT doc_id, lang, source, 'documents.parquet' AS source_file FROM documents")
def scan_catalog(spark, sf_dir):
    return catalog.scan_catalog(spark, sf_dir, ["documents.parquet"], ["doc_id", "lang", "source"]).drop("source_row")


@query("scan_sample", "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 1000")
def scan_sample(spark, sf_dir):
    return catalog.sample_rows(table(spark, sf_dir, "pages"), ["page_id", "url"], ["page_id"], 1000)


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_table(spark, sf_dir):
    return table(spark, sf_dir, "customer")


@query(
    "project_columns",
    "SELECT p_partkey, p_name, p_brand, p_type, '' AS caption, p_retailprice AS price FROM part",
)
def project_columns(spark, sf_dir):
    """Drop what is not needed, add a placeholder caption, rename."""
    return table(spark, sf_dir, "part").drop("p_size").withColumn("caption", F.lit("")).withColumnRenamed("p_retailprice", "price")


@query("sink_by_resolution", f"{DOC_BUCKETED} SELECT doc_id, resolution FROM bucketed")
def sink_by_resolution(spark, sf_dir):
    out = shared_dir(spark, "by-resolution")
    writers.write_by_resolution(assign_bucket(doc_images(spark, sf_dir), GRID_1024).select("doc_id", "text", "resolution"), out)
    return spark.read.schema("doc_id bigint, text string, resolution string").parquet(out).select("doc_id", "resolution")


@query(
    "sink_by_shard",
    """SELECT 'shard_' || page_id % 10 AS shard, page_id, length(html)::BIGINT AS n_chars FROM pages""",
)
def sink_by_shard(spark, sf_dir):
    """Written twice: the second write replaces the same folders."""
    out = shared_dir(spark, "by-shard")
    shard = F.concat(F.lit("shard_"), (F.col("page_id") % 10).cast("string"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.length("html").cast("bigint").alias("n_chars"), shard.alias("shard"))
    writers.write_by_shard(pages, out)
    writers.write_by_shard(pages, out)
    return spark.read.parquet(out).select("shard", "page_id", "n_chars")


@query("sink_rolled", f"WITH {LINE_IMAGES_SQL} SELECT count(*) AS images, 0::BIGINT AS files_over_cap FROM line_images")
def sink_rolled(spark, sf_dir):
    out = shared_dir(spark, "rolled")
    writers.write_rolled(line_images(spark, sf_dir), out, 10_000)
    per_file = spark.read.parquet(out).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("images"), F.count_if(F.col("n") > 10_000).alias("files_over_cap"))


@query("export_map_json", "SELECT doc_id::VARCHAR AS key, text AS caption FROM documents")
def export_map_json(spark, sf_dir):
    """JSON Lines out and back in: keys and whole texts survive."""
    out = shared_dir(spark, "map-json")
    writers.export_map_json(table(spark, sf_dir, "documents"), "doc_id", "text", out)
    return catalog.load_caption_map(spark, out, wholetext=False)


@query("caption_map_load", "SELECT doc_id::VARCHAR AS key, quality::VARCHAR AS caption FROM labels")
def caption_map_load(spark, sf_dir):
    """One JSON object per file, one file per Arrow batch of the labels scan; converted to Parquet once."""
    out = shared_dir(spark, "caption-map")

    def one_object(batches):
        for pdf in batches:
            entries = [f'"{d}": {{"caption": "{q}"}}' for d, q in zip(pdf["doc_id"], pdf["quality"])]
            yield pd.DataFrame({"value": ["{" + ",\n".join(entries) + "}"]})

    objects = table(spark, sf_dir, "labels").mapInPandas(one_object, "value string")
    objects.write.option("maxRecordsPerFile", 1).text(f"{out}/json")
    loaded = catalog.convert_caption_map(spark, f"{out}/json", f"{out}/parquet", "struct<caption:string>")
    return loaded.select("key", F.col("caption.caption").alias("caption"))


@query("caption_map_split", """SELECT doc_id || '"}{,\\' AS key, text AS caption FROM documents""")
def caption_map_split(spark, sf_dir):
    """All documents as one JSON object in one file, read back by a task for every quarter of a megabyte."""
    out = shared_dir(spark, "caption-split")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = docs.agg(F.min("doc_id")).first()[0]

    def quoted(text):
        return F.expr(f"substring(to_json(struct({text} as k)), 6, length(to_json(struct({text} as k))) - 6)")

    key = quoted("concat(cast(doc_id as string), '\"}{,\\\\')")
    comma = F.when(F.col("doc_id") == first, "").otherwise(",")
    value = F.when(F.col("text").isNull(), "null").otherwise(quoted("text"))
    lines = docs.select(F.lit(1).alias("part"), "doc_id", F.concat(comma, key, F.lit(": "), value).alias("value"))
    ends = spark.createDataFrame([(0, None, "{"), (2, None, "}")], lines.schema)
    lines.unionByName(ends).repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id").select("value").write.text(f"{out}/lines")
    writers.join_files(spark, f"{out}/lines", ".txt", f"{out}/json/all.json")
    return catalog.convert_caption_map(spark, f"{out}/json", f"{out}/parquet", range_bytes=1 << 18)


@query(
    "regroup_catalog",
    """SELECT doc_id, (1 + doc_id % 4) || '-' || (1 + doc_id % 3) AS aspect_ratio_bucket FROM documents""",
)
def regroup_catalog(spark, sf_dir):
    """``top/least_dim_range=/aspect_ratio_bucket=`` folders regrouped by aspect only."""
    out = shared_dir(spark, "regroup")
    n = F.col("doc_id")
    aspect = F.concat((1 + n % 4).cast("string"), F.lit("-"), (1 + n % 3).cast("string"))
    smallest = F.concat((256 * (1 + n % 2)).cast("string"), F.lit("-"), (256 * (2 + n % 2)).cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", smallest.alias("least_dim_range"), aspect.alias("aspect_ratio_bucket"))
    for top in (0, 1):
        part = docs.filter(n % 2 == top)
        writers.write_partitioned(part, f"{out}/in/{top}", ["least_dim_range", "aspect_ratio_bucket"])
    rows = catalog.scan_catalog(spark, f"{out}/in", ["0", "1"], ["doc_id", "text"], schema="doc_id bigint, text string")
    writers.write_partitioned(catalog.regroup(rows, "aspect_ratio_bucket"), f"{out}/regrouped", ["aspect_ratio_bucket"], rebalance=False)
    return spark.read.parquet(f"{out}/regrouped").select("doc_id", "aspect_ratio_bucket")


def write_shards(rows, folder: str) -> None:
    """``(shard, member, payload BINARY)`` rows to one tar per shard; a task holds one shard at a time."""

    def run(batches):
        for members in split_on_keys(batches, ["shard"]):
            shard = members["shard"].iloc[0]
            system, inner = resolve(f"{folder}/{shard}.tar")
            system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(inner) as stream, tarfile.open(fileobj=stream, mode="w|") as archive:
                for name, payload in zip(members["member"], members["payload"]):
                    info = tarfile.TarInfo(name)
                    info.size = len(payload)
                    archive.addfile(info, io.BytesIO(payload))
            yield pd.DataFrame({"shard": [shard], "members": [len(members)]})

    placed = rows.repartition("shard").sortWithinPartitions("shard", "member")
    placed.mapInPandas(run, "shard string, members bigint").write.format("noop").mode("overwrite").save()


def page_members(spark, sf_dir, per_shard):
    """Two members a page: its text as if it were an image, and a sidecar with its url."""
    pages = table(spark, sf_dir, "pages")
    number = F.col("page_id").cast("string")
    members = F.array(
        F.struct(F.concat(F.lit("img/"), number, F.lit(".jpg")).alias("member"), F.col("html").cast("binary").alias("payload")),
        F.struct(
            F.concat(F.lit("meta/"), number, F.lit(".json")).alias("member"),
            F.concat(F.lit('{"url":"'), F.col("url"), F.lit('"}')).cast("binary").alias("payload"),
        ),
    )
    shard = F.concat(F.lit("shard_"), F.floor(F.col("page_id") / per_shard).cast("string"))
    return pages.select(shard.alias("shard"), F.explode(members).alias("m")).select("shard", "m.*")


@query(
    "scan_tar",
    """WITH members AS (
  SELECT 'shard_' || page_id // 64 || '.tar' AS shard, 'img/' || page_id || '.jpg' AS member, html AS payload FROM pages
  UNION ALL SELECT 'shard_' || page_id // 64 || '.tar', 'meta/' || page_id || '.json', '{"url":"' || url || '"}' FROM pages)
SELECT shard, member, octet_length(encode(payload)) AS size, CASE WHEN member LIKE '%.json' THEN payload END AS content,
       md5(payload) AS digest FROM members""",
)
def scan_tar(spark, sf_dir):
    """Pages as shards of 64; members listed from headers, payloads fetched by byte range."""
    out, listing = shared_dir(spark, "tar"), shared_dir(spark, "tar-members")
    write_shards(page_members(spark, sf_dir, 64), out)
    tar.scan_tar(spark, out).select("shard", "member", "offset", "size", "content").write.parquet(listing)
    fetched = tar.fetch_members(spark.read.parquet(listing), out)
    return fetched.select("shard", "member", "size", "content", F.md5("bytes").alias("digest"))


LARGE_SHARDS_SQL = """members AS (
  SELECT 'shard_' || page_id // 1000 || '.tar' AS shard, 'img/' || page_id || '.jpg' AS member, octet_length(encode(html)) AS size, NULL AS content FROM pages
  UNION ALL SELECT 'shard_' || page_id // 1000 || '.tar', 'meta/' || page_id || '.json', octet_length(encode('{"url":"' || url || '"}')), '{"url":"' || url || '"}' FROM pages)"""


@query("scan_tar_split", f"WITH {LARGE_SHARDS_SQL} SELECT shard, member, size, content FROM members")
def scan_tar_split(spark, sf_dir):
    """Pages as shards of 1,000, each walked by a task for every quarter of a megabyte."""
    out = shared_dir(spark, "tar-split")
    write_shards(page_members(spark, sf_dir, 1000), out)
    return tar.scan_tar(spark, out, range_bytes=1 << 18).select("shard", "member", "size", "content")


@query("scan_tar_filtered", f"WITH {LARGE_SHARDS_SQL} SELECT shard, member, content FROM members WHERE shard = 'shard_0.tar' AND member LIKE 'meta/%.json'")
def scan_tar_filtered(spark, sf_dir):
    """One shard's sidecars: the filters go into the source."""
    out = shared_dir(spark, "tar-filtered")
    write_shards(page_members(spark, sf_dir, 1000), out)
    rows = tar.scan_tar(spark, out).filter((F.col("shard") == "shard_0.tar") & F.col("member").startswith("meta/") & F.col("member").endswith(".json"))
    return rows.select("shard", "member", "content")


@query("stream_shards", f"WITH {LARGE_SHARDS_SQL} SELECT shard, member, size FROM members")
def stream_shards(spark, sf_dir):
    """Shards taken as they arrive, three per micro-batch: half of them, then after a restart the others."""
    out = shared_dir(spark, "tar-stream")
    shards = page_members(spark, sf_dir, 1000)
    first = F.pmod(F.xxhash64("shard"), F.lit(2)) == 0
    for part in (first, ~first):
        write_shards(shards.where(part), f"{out}/in")
        intake.take_shards(spark, f"{out}/in", lambda m: m.select("shard", "member", "size"), f"{out}/rows", f"{out}/checkpoint", max_shards=3)
    return spark.read.schema("shard string, member string, size bigint").parquet(f"{out}/rows")


@query(
    "image_dims",
    f"""WITH {PICTURES_SQL}
SELECT doc_id, width::BIGINT AS width, height::BIGINT AS height, CASE channels WHEN 1 THEN 'L' WHEN 3 THEN 'RGB' ELSE 'RGBA' END AS mode FROM pictures""",
)
def image_dims(spark, sf_dir):
    return add_dimensions(pictures(spark, sf_dir).select("doc_id", "jpg"), "jpg").drop("jpg")


