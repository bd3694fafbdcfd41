"""Line dedup over overlapping windows of three lines, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import stored


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """Remove every later occurrence of ``window`` consecutive lines seen before.

    Returns the columns of ``docs`` with the remaining text in ``text_col``, plus
    ``lines_total``, ``lines_removed`` and ``spans_removed`` (maximal runs), which
    replace columns of those names.

    The first occurrence is the one of the smallest (id, line number), null ids
    last; each line that a later occurrence covers goes, also where occurrences
    overlap. What repeats is judged on the input, not on what is left. Texts of
    fewer lines than a window lose nothing; a null text stays null with no lines.
    Rows with equal id and text count as one document and stay alike; rows with
    one id and different texts are different documents.

    Texts become windows in the scan; windows are compared as two independent
    64-bit hashes, the first occurrence is a minimum combined before the shuffle,
    and the join that finds later ones reads written tables on both sides, so
    adaptive execution can split a window that fills a third of all rows.
    """
    own_key = F.xxhash64(F.col(text_col))
    lines = F.split(F.col(text_col), "\n", -1)
    slim = docs.select(F.col(id_col).alias("id"), own_key.alias("key"), lines.alias("l")).where(F.size("l") >= window)
    slim = slim.select("id", "key", F.transform("l", lambda x: F.xxhash64(x)).alias("a"), F.transform("l", lambda x: F.xxhash64(F.lit(1), x)).alias("b"))

    def key_at(i, column):
        return F.xxhash64(*[F.get(F.col(column), i + k) for k in range(window)])

    at = F.transform(F.sequence(F.lit(0), F.size("a") - window), lambda i: F.struct(i.alias("pos"), key_at(i, "a").alias("h1"), key_at(i, "b").alias("h2")))
    windows = stored(slim.select("id", "key", F.inline(at)), "windows")
    order = F.struct(F.col("id").isNull().alias("n"), "id", "key", "pos")
    firsts = windows.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.max(order).alias("last")).where("first <> last")
    firsts = stored(firsts.select("h1", "h2", "first"), "firsts")
    later = windows.join(firsts, ["h1", "h2"]).where(order != F.col("first"))
    covered = later.groupBy("id", "key").agg(F.collect_set("pos").alias("__at"))
    covered = covered.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "__at")
    out = docs.withColumn("__own", own_key).join(covered, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform("__at", lambda p: F.sequence(p, p + (window - 1))))))
    total = F.coalesce(F.size(F.col("__lines")), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    text = F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")
    runs = F.size(F.filter("__gone", lambda p, j: (j == 0) | (F.get(F.col("__gone"), j - 1) < p - 1)))
    out = out.withColumn("__lines", lines).withColumn("__gone", gone)
    touched = F.col("__at").isNotNull()
    out = out.withColumns({
        "lines_total": F.when(F.col(text_col).isNull(), 0).otherwise(total).cast("long"),
        "lines_removed": F.when(touched, F.size("__gone")).otherwise(0).cast("long"),
        "spans_removed": F.when(touched, runs).otherwise(0).cast("long"),
    })
    out = out.withColumn(text_col, F.when(touched, text).otherwise(F.col(text_col)))
    return out.drop("__own", "__id", "__key", "__at", "__lines", "__gone")


LINES_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS pos FROM d WHERE text IS NOT NULL),
k AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY ls[pos + 1], ls[pos + 2], ls[pos + 3] ORDER BY doc_id, pos) AS nth FROM w),
gone AS (SELECT DISTINCT doc_id, pos + k AS i FROM k, (VALUES (0), (1), (2)) AS s(k) WHERE nth > 1),
runs AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE first) AS spans
         FROM (SELECT doc_id, lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS DISTINCT FROM i - 1 AS first FROM gone) GROUP BY doc_id),
left_over AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
              FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS i FROM d) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(l.text, '') END AS text, coalesce(len(d.ls), 0) AS lines_total,
       coalesce(r.n, 0) AS lines_removed, coalesce(r.spans, 0) AS spans_removed
FROM d LEFT JOIN runs r USING (doc_id) LEFT JOIN left_over l USING (doc_id)
"""


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` after ``dedup_lines``, same columns; ``chars_col``, if there, is counted anew.

    Documents that lost all their text go; those that had none stay.
    """
    work = docs.withColumnsRenamed({c: f"__in_{c}" for c in docs.columns})
    out = dedup_lines(work, f"__in_{id_col}", f"__in_{text_col}")
    out = out.where((F.col("lines_removed") == 0) | (F.length(f"__in_{text_col}") > 0))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        changed = F.length(f"__in_{text_col}").cast(kind)
        out = out.withColumn(f"__in_{chars_col}", F.when(F.col("lines_removed") > 0, changed).otherwise(F.col(f"__in_{chars_col}")))
    return out.select(*[F.col(f"__in_{c}").alias(c) for c in docs.columns])
