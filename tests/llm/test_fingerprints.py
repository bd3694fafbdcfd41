import hashlib

from pyspark.sql import functions as F

from shapeloom.llm import fingerprints as fp
from shapeloom.llm import queries


def lines(text):
    return {x for x in (text or "").split("\n") if x}


def alike(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out[key] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), round(alike(lines(text), lines(edited)), 12), round(alike(lines(text), lines(after)), 12))
    return out


def got(frame, key):
    return {r[key]: (r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in frame.collect()}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op3_fingerprints(spark, "/root/testdata/sf0.001")
    assert got(rows, "doc_id") == brute([tuple(d) for d in docs])
    by_text = {}
    texts = {d.doc_id: d.text for d in docs}
    for r in rows.collect():
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_many_differences_need_larger_sketches(spark):
    texts = ["\n".join(f"{i} line {n}" for n in range(size)) for i, size in enumerate([1, 3, 30, 200, 900, 4000])]
    texts += [texts[4] + "\nmore", texts[4]]
    rows = list(enumerate(texts))
    assert got(fp.compare_versions(spark.createDataFrame(rows, "doc_id long, text string")), "id") == brute(rows)


def test_next_row_over_many_blocks(spark):
    ids = [7 * i * i % 10_007 for i in range(500)]
    docs = spark.createDataFrame([(i, f"t{i}") for i in set(ids)], "doc_id long, text string").repartition(4)
    order = sorted(set(ids), reverse=True)
    for size in (10, 10_000):
        rows = fp.with_next(docs, "doc_id", ["text"], "next", rows_per_block=size).select("doc_id", F.col("next.text").alias("t")).collect()
        assert {r.doc_id: r.t for r in rows} == {a: f"t{b}" for a, b in zip(order, [*order[1:], order[0]])}


def test_odd_rows(odd_docs, no_docs):
    out = fp.compare_versions(odd_docs).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert len({r.fingerprint for r in out if r.id == 4}) == 1
    assert fp.compare_versions(no_docs).count() == 0


def test_peeling_returns_the_digests(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4], [3, 4, 5])], "a array<long>, b array<long>")
    found = fp.with_difference(rows, "a", "b", "d").first().d
    assert sorted((e.s, e.k) for e in found) == [(-1, 5), (1, 1), (1, 2)]
