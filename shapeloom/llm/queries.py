"""One query per operator over the shared tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapeloom.llm import chat, fingerprints, hard_negatives, lexical, licenses, lines, mixing, ngram_join, personal, pieces, quality, substrings, vectors
from shapeloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Domains of the table ``labels`` and the token shares that the mixture aims at; the first keeps its tokens.
MIX_TARGETS = {"clean": 0.975, "low": 0.02, "toxic": 0.005}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def label_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as one domain per document: toxic before low quality before clean."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE["op4_line_dedup"] = lines.LINES_SQL


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rated, _ = mixing.mix_rates(docs, label_domains(spark, sf_dir), MIX_TARGETS, anchor="clean", carry=["doc_id", "source"])
    return rated.select("doc_id", "source", "tokens", "chances", "rate", "copies")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify_quality(docs)
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= 0.5).alias("keep"))


@query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load_model()
    docs = pieces.with_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    read = docs.withColumn("back", pieces.decode(F.col("pieces"), model))
    return read.select("doc_id", F.size("pieces").alias("n_pieces"), "pieces", F.col("back").eqNullSafe(F.col("text")).alias("lossless"))


@query
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.chat_digests(chat.format_chats(turns.union(extra)))


def _escaped_sql() -> str:
    out = "replace(text, chr(92), chr(92) || chr(92))"
    for mark in (m.decode() for m in chat.CONTROL):
        out = f"replace({out}, '{mark}', '{mark[0]}' || chr(92) || '{mark[1:]}')"
    return out


ORACLE["op1_chat_format"] = f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(coalesce(role, '')) + length({_escaped_sql()}) + 24)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_versions(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "licenses", F.size("found").cast("long").alias("n_found"), "found")


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    return left.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"item": "item_id", "id": "doc_id"})


ORACLE["op11_lexical_search"] = lexical.RANKED_SQL


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine_negatives(rows.withColumn("label", moved), "vec_id % 50 = 0")
    return found.withColumnsRenamed({"anchor": "anchor_id", "positive": "positive_id", "negative": "negative_id"})


ORACLE["op12_hard_negatives"] = hard_negatives.NEGATIVES_SQL


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.with_personal_data(docs)

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter(plain, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    plain = F.filter("spans", lambda x: ~x["added"])
    return found.select("doc_id", *map(number, personal.KINDS), F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
