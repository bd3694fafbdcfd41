import math
import re
from collections import Counter

import pytest

from check import compare, connect
from shapeloom.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    held = [c for _, c in counts if c]
    n, length = len(held), sum(sum(c.values()) for c in held)
    df = Counter(t for c in held for t in c)
    out = {}
    for item, text in items:
        scores = []
        for i, c in counts:
            if not c:
                continue
            m = 25 + 75 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out |= {(item, r + 1): (None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:k])}
    return out


def got(frame):
    return {(r.item, r.rank): (r.id, r.score) for r in frame.collect()}


DOCS = [
    (1, "the cat's hat, the HAT"), (2, "Straße STRASSE café Café ÉTÉ"), (3, None), (4, ""), (5, " .,;\n"), (6, "hat"), (7, "hat"), (None, "hat"), (7, "hat"),
    (8, "ca t hats that"), (9, "\x00hat\x7fhat 中文 hat中文"), (10, "word " * 60_000 + "rare"), (11, "x" * 300_000), (12, "𝄞hat 𝄞"),
]
ITEMS = [(0, "hat hat CAT"), (1, "café straße Été"), (2, "中文"), (3, None), (4, ""), (5, "absent"), (6, "rare word"), (7, "𝄞 x" + "x" * 50), (None, "hat")]


@pytest.mark.parametrize("group_bytes", [8 << 20, 200])
def test_against_plain_counts(spark, group_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = lexical.rank_documents(docs, items.union(items), k=3, group_bytes=group_bytes)
    assert found.count() == len(got(found))
    assert got(found) == brute(DOCS, ITEMS, 3)


def test_ties_across_tasks_go_by_the_smaller_id(spark):
    docs = [(i, "one two") for i in range(200)] + [(1000 + i, f"other{i}") for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(16)
    items = spark.createDataFrame([(1, "two")], "item_id int, text string")
    assert [r.id for r in lexical.rank_documents(frame, items).orderBy("rank").collect()] == list(range(10))


def test_small_slices_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(lexical, "_CELLS", 1)
    monkeypatch.setattr(lexical, "_CHUNK", 4)
    assert got(lexical.rank_documents(docs, items)) == brute(DOCS, ITEMS)


def test_odd_rows(odd_docs, no_docs):
    items = odd_docs.withColumnsRenamed({"doc_id": "item_id"}).select("item_id", "text")
    clash = odd_docs.withColumnsRenamed({"n_chars": "score", "source": "item"})
    rows = lexical.rank_documents(clash, items.where("length(text) < 100")).collect()
    assert rows and all(r.score > 0 for r in rows)
    assert lexical.rank_documents(no_docs, items).count() == 0
    assert lexical.rank_documents(clash, items.limit(0)).count() == 0


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(queries.op11_lexical_search(spark, folder), connect(folder), queries.ORACLE["op11_lexical_search"]) == ""
