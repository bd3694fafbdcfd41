"""Shard members, sidecars and caption lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from shapeloom.functions import captions as cap
from shapeloom.functions import paths
from shapeloom.operators import consolidate, joins
from shapeloom.operators.ledger import split_rejects
from shapeloom.session import table
from shapeloom.workload import query

PATHS_SQL = """paths AS (
  SELECT page_id, url, 'shard_' || page_id % 10 || '/' || page_id || e.ext AS path
  FROM pages, (VALUES ('.jpg'), ('.v2.jpg'), ('.json'), ('.JPG'), ('.')) e(ext)
  UNION ALL SELECT page_id, url, 'shard_' || page_id % 10 || '/.' || page_id || '.json' FROM pages)"""


def page_paths(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    shard = F.concat(F.lit("shard_"), (F.col("page_id") % 10).cast("string"), F.lit("/"))
    number = F.col("page_id").cast("string")
    names = [F.concat(shard, number, F.lit(e)) for e in (".jpg", ".v2.jpg", ".json", ".JPG", ".")]
    return pages.select("page_id", "url", F.explode(F.array(*names, F.concat(shard, F.lit("."), number, F.lit(".json")))).alias("path"))


@query(
    "member_filter",
    f"""WITH {PATHS_SQL}, named AS (SELECT *, string_split(path, '/')[-1] AS base FROM paths)
SELECT page_id, path, base LIKE '%.jpg' AS is_image, base LIKE '%.json' AND base NOT LIKE '.%' AS is_sidecar
FROM named WHERE base LIKE '%.jpg' OR (base LIKE '%.json' AND base NOT LIKE '.%')""",
)
def member_filter(spark, sf_dir):
    image, sidecar = paths.is_image_member(F.col("path")), paths.is_sidecar_member(F.col("path"))
    members = page_paths(spark, sf_dir).filter(image | sidecar)
    return members.select("page_id", "path", image.alias("is_image"), sidecar.alias("is_sidecar"))


@query(
    "path_stem",
    f"""WITH {PATHS_SQL}, both_kinds AS (SELECT page_id, path FROM paths UNION ALL SELECT page_id, url FROM pages)
SELECT page_id, path, string_split(path, '/')[-1] AS base, split_part(string_split(path, '/')[-1], '.', 1) AS stem FROM both_kinds""",
)
def path_stem(spark, sf_dir):
    names = page_paths(spark, sf_dir).select("page_id", "path")
    urls = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    both = consolidate.union_tables([names, urls])
    return both.select("page_id", "path", paths.basename(F.col("path")).alias("base"), paths.stem(F.col("path")).alias("stem"))


# Image members with 0 to 2 sidecars per stem, plus hidden and wrong-case names.
MEMBERS_SQL = """members AS (
  SELECT 'shard_' || page_id % 10 AS shard, 'img/' || page_id || CASE WHEN page_id % 13 = 0 THEN '.JPG' ELSE '.jpg' END AS member, NULL AS content FROM pages
  UNION ALL SELECT 'shard_' || page_id % 10, 'meta/' || page_id || '.json', '{"from":"meta","url":"' || url || '"}' FROM pages WHERE page_id % 7 <> 0
  UNION ALL SELECT 'shard_' || page_id % 10, 'alt/' || page_id || '.v2.json', '{"from":"alt","url":"' || url || '"}' FROM pages WHERE page_id % 3 = 0
  UNION ALL SELECT 'shard_' || page_id % 10, 'aaa/.' || page_id || '.json', '{"from":"hidden"}' FROM pages WHERE page_id % 4 = 0)"""


def page_members(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.col("page_id").cast("string")

    def doc(origin):
        return F.concat(F.lit('{"from":"' + origin + '","url":"'), F.col("url"), F.lit('"}'))

    extension = F.when(F.col("page_id") % 13 == 0, ".JPG").otherwise(".jpg")
    nothing = F.lit(None).cast("struct<member:string,content:string>")
    entries = F.array(
        F.struct(F.concat(F.lit("img/"), number, extension).alias("member"), F.lit(None).cast("string").alias("content")),
        F.when(F.col("page_id") % 7 != 0, F.struct(F.concat(F.lit("meta/"), number, F.lit(".json")).alias("member"), doc("meta").alias("content"))).otherwise(nothing),
        F.when(F.col("page_id") % 3 == 0, F.struct(F.concat(F.lit("alt/"), number, F.lit(".v2.json")).alias("member"), doc("alt").alias("content"))).otherwise(nothing),
        F.when(F.col("page_id") % 4 == 0, F.struct(F.concat(F.lit("aaa/."), number, F.lit(".json")).alias("member"), F.lit('{"from":"hidden"}').alias("content"))).otherwise(nothing),
    )
    rows = pages.select(F.concat(F.lit("shard_"), (F.col("page_id") % 10).cast("string")).alias("shard"), F.explode(entries).alias("e"))
    return rows.filter(F.col("e").isNotNull()).select("shard", "e.member", "e.content")


@query(
    "pair_members",
    f"""WITH {MEMBERS_SQL}, named AS (SELECT *, string_split(member, '/')[-1] AS base FROM members),
stems AS (SELECT *, split_part(base, '.', 1) AS stem FROM named),
sidecars AS (SELECT shard, stem, min(member) AS json_member, arg_min(content, member) AS json_text FROM stems
  WHERE base LIKE '%.json' AND base NOT LIKE '.%' GROUP BY shard, stem)
SELECT shard, member, stem, json_member, json_text FROM stems JOIN sidecars USING (shard, stem) WHERE base LIKE '%.jpg'""",
)
def pair_members(spark, sf_dir):
    return joins.pair_members(page_members(spark, sf_dir))


# Sidecar documents built from events: some damaged, some without key, url or caption.
SIDECAR_SQL = """docs AS (
  SELECT event_id, event_type, CASE WHEN event_id % 17 = 0 THEN '{"key": "' || event_id || '", "url" broken'
    ELSE '{"key": "' || CASE WHEN event_id % 11 = 0 THEN '' ELSE event_id::VARCHAR END || '"'
      || CASE WHEN event_id % 3 = 0 THEN '' ELSE ', "url": "http://img/' || user_id || '"' END
      || CASE event_id % 5 WHEN 1 THEN '' WHEN 2 THEN ', "caption": null' ELSE ', "caption": "a ' || event_type || '"' END
      || ', "props": ' || props || '}' END AS doc FROM events),
parsed AS (
  SELECT event_id, event_type, json_valid(doc) AS valid,
    CASE WHEN json_valid(doc) THEN doc END AS good FROM docs),
fields AS (
  SELECT event_id, event_type, valid, good ->> '$.key' AS key, good ->> '$.url' AS url,
    CASE WHEN good IS NULL THEN NULL WHEN list_contains(json_keys(good), 'caption') THEN good ->> '$.caption' ELSE '' END AS caption
  FROM parsed)"""


def sidecar_docs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    n = F.col("event_id")
    key = F.when(n % 11 == 0, F.lit("")).otherwise(number)
    url = F.when(n % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(', "url": "http://img/'), F.col("user_id").cast("string"), F.lit('"')))
    caption = (
        F.when(n % 5 == 1, F.lit(""))
        .when(n % 5 == 2, F.lit(', "caption": null'))
        .otherwise(F.concat(F.lit(', "caption": "a '), F.col("event_type"), F.lit('"')))
    )
    whole = F.concat(F.lit('{"key": "'), key, F.lit('"'), url, caption, F.lit(', "props": '), F.col("props"), F.lit("}"))
    broken = F.concat(F.lit('{"key": "'), number, F.lit('", "url" broken'))
    return events.select("event_id", "event_type", F.when(n % 17 == 0, broken).otherwise(whole).alias("doc"))


def parsed_sidecars(spark, sf_dir):
    return cap.with_sidecar(sidecar_docs(spark, sf_dir), "doc").drop("doc")


@query("json_sidecar", f"WITH {SIDECAR_SQL} SELECT event_id, valid, key, url, caption FROM fields")
def json_sidecar(spark, sf_dir):
    return parsed_sidecars(spark, sf_dir).drop("event_type")


@query(
    "valid_metadata",
    f"WITH {SIDECAR_SQL} SELECT event_id, key, url FROM fields WHERE key IS NOT NULL AND key <> '' AND url IS NOT NULL AND url <> ''",
)
def valid_metadata(spark, sf_dir):
    return joins.valid_metadata(parsed_sidecars(spark, sf_dir), ["key", "url"]).select("event_id", "key", "url")


@query(
    "reject_rows",
    f"""WITH {SIDECAR_SQL}
SELECT event_type, 'kept' AS outcome, count(*) AS documents FROM fields WHERE valid GROUP BY event_type
UNION ALL SELECT event_type, 'rejected', count(*) FROM fields WHERE NOT valid GROUP BY event_type""",
)
def reject_rows(spark, sf_dir):
    marked = parsed_sidecars(spark, sf_dir).withColumn("error", F.when(~F.col("valid"), F.lit("malformed sidecar")))
    good, bad = split_rejects(marked)
    sides = [side.select("event_type", F.lit(name).alias("outcome")) for side, name in ((good, "kept"), (bad, "rejected"))]
    return consolidate.union_tables(sides).groupBy("event_type", "outcome").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "caption_left_join",
    """WITH probe AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, url || '#' || page_id FROM pages
  UNION ALL SELECT page_id, NULL FROM pages)
SELECT r.page_id, r.url,
  CASE WHEN p.page_id IS NULL OR p.page_id % 5 = 1 THEN '' WHEN p.page_id % 5 = 2 THEN NULL ELSE 'i' || p.page_id END AS internlm,
  CASE WHEN p.page_id IS NULL THEN '' ELSE 'f' || p.page_id END AS florence,
  CASE WHEN p.page_id IS NULL THEN '' ELSE 's' || p.page_id END AS sharecap
FROM probe r LEFT JOIN (SELECT * FROM pages WHERE page_id % 3 <> 0) p ON r.url = p.url""",
)
def caption_left_join(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    unmatched = pages.withColumn("url", F.concat("url", F.lit("#"), F.col("page_id").cast("string")))
    probe = consolidate.union_tables([pages, unmatched, pages.withColumn("url", F.lit(None).cast("string"))])
    number = F.col("page_id").cast("string")
    value = {f: F.concat(F.lit(p), number) for f, p in zip(cap.SHORT_CAPTION_FIELDS, "ifs")}
    first, second, third = cap.SHORT_CAPTION_FIELDS
    always = [F.lit(second), value[second], F.lit(third), value[third]]
    caps = F.when(F.col("page_id") % 5 == 1, F.create_map(*always)).otherwise(
        F.create_map(F.lit(first), F.when(F.col("page_id") % 5 != 2, value[first]), *always)
    )
    dictionary = pages.filter(F.col("page_id") % 3 != 0).select("url", caps.alias("caps"))
    joined = joins.optional_captions(probe, dictionary, spread_by=["page_id"])
    names = ("internlm", "florence", "sharecap")
    return joined.select("page_id", "url", *[F.col("caption")[i].alias(n) for i, n in enumerate(names)])


LABEL_CAPTIONS_SQL = "label_captions AS (SELECT doc_id, 'quality ' || quality || ' toxic ' || toxic AS label_caption FROM labels)"


def label_captions(spark, sf_dir):
    text = F.concat(F.lit("quality "), F.col("quality").cast("string"), F.lit(" toxic "), F.col("toxic").cast("string"))
    return table(spark, sf_dir, "labels").select("doc_id", text.alias("label_caption"))


@query(
    "caption_required",
    f"WITH {LABEL_CAPTIONS_SQL} SELECT doc_id, lang, label_caption FROM documents JOIN label_captions USING (doc_id)",
)
def caption_required(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.required_captions(docs, label_captions(spark, sf_dir), "doc_id", "label_caption", on_missing="drop")


@query(
    "caption_array",
    f"""WITH {LABEL_CAPTIONS_SQL}, both_captions AS (
  SELECT doc_id, text, coalesce(label_caption, '') AS label_caption FROM documents LEFT JOIN label_captions USING (doc_id))
SELECT doc_id, 0::BIGINT AS pos, text AS caption FROM both_captions UNION ALL SELECT doc_id, 1, label_caption FROM both_captions""",
)
def caption_array(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    looked_up = joins.required_captions(docs, label_captions(spark, sf_dir), "doc_id", "label_caption", on_missing="null")
    pair = F.array("text", F.coalesce("label_caption", F.lit("")))
    return looked_up.select("doc_id", F.posexplode(pair).alias("pos", "caption")).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "captions_last_wins",
    """SELECT conv_id, role, arg_max(text, turn) AS text, max(turn) AS turn FROM conversations GROUP BY conv_id, role""",
)
def captions_last_wins(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations")
    return consolidate.last_wins(talk, ["conv_id", "role"], ["turn"], ["text", "turn"])


@query(
    "merge_last_wins",
    """WITH ranked AS (SELECT l_partkey, l_suppkey % 4 AS map_rank, max(l_shipdate) AS shipped FROM lineitem GROUP BY ALL)
SELECT l_partkey, strftime(arg_max(shipped, map_rank), '%Y-%m-%d') AS shipped FROM ranked GROUP BY l_partkey""",
)
def merge_last_wins(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    maps = [
        lines.filter(F.col("l_suppkey") % 4 == rank).groupBy("l_partkey").agg(F.max("l_shipdate").alias("shipped")) for rank in range(4)
    ]
    merged = consolidate.merge_ranked(maps, ["l_partkey"], ["shipped"])
    return merged.withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


@query(
    "union_catalogs",
    """SELECT 'customer' AS catalog, c_custkey AS id, c_name AS name FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part""",
)
def union_catalogs(spark, sf_dir):
    parts = []
    for name, prefix in (("customer", "c_custkey c_name"), ("supplier", "s_suppkey s_name"), ("part", "p_partkey p_name")):
        key, label = prefix.split()
        parts.append(table(spark, sf_dir, name).select(F.lit(name).alias("catalog"), F.col(key).alias("id"), F.col(label).alias("name")))
    return consolidate.union_tables(parts)
