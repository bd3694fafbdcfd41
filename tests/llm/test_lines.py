import duckdb
import pytest

from check import compare, connect
from shapeloom.llm import lines, queries


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(queries.op4_line_dedup(spark, folder), connect(folder), lines.LINES_SQL) == ""


def test_overlaps_ties_and_short_texts(spark):
    rows = [(1, "a\nb\nc"), (2, "x\na\nb\nc\ny"), (3, "a\nb"), (4, "q\nq\nq\nq\nq"), (5, "c\na\nb\nc\na"), (6, "a\nb\nc\n"), (7, "\n\n\n\n"), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert compare(lines.dedup_lines(docs), con, lines.LINES_SQL) == ""
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert got[2].text == "x\ny" and got[4].text == "q" and got[3].text == "a\nb" and got[8].text is None
    assert (got[2].lines_total, got[2].lines_removed, got[2].spans_removed) == (5, 3, 1)


def test_odd_rows(odd_docs, no_docs):
    clashing = odd_docs.withColumnsRenamed({"source": "lines_total", "rate": "__at"})
    assert lines.dedup_lines(odd_docs).count() == odd_docs.count()
    kept = lines.without_repeated_lines(clashing)
    assert kept.columns == clashing.columns and kept.count() == odd_docs.count()
    assert lines.without_repeated_lines(no_docs).count() == 0


def test_documents_that_lose_all_text_go(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc", 5), (2, "a\nb\nc", 5), (3, "d\na\nb\nc", 7), (4, "", 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in lines.without_repeated_lines(docs).collect()}
    assert got == {1: ("a\nb\nc", 5), 3: ("d", 1), 4: ("", 0)}


def test_a_window_in_every_document_is_removed_everywhere_but_once(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('own ', id, '\\nr\\ns\\nt') AS text")
    left = lines.dedup_lines(docs).where("lines_removed = 0").collect()
    assert [r.doc_id for r in left] == [0]
