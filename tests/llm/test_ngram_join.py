import random
from collections import defaultdict

import pytest

from shapeloom.llm import blocks, ngram_join, queries
from shapeloom.llm.components import connected_components


def brute(rows, n=5, similarity=0.8):
    sets = {}
    for key, text in rows:
        words = (text or "").lower().encode().split()
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    holders = defaultdict(list)
    for key, grams in sets.items():
        for g in grams:
            holders[g].append(key)
    shared = defaultdict(int)
    for keys in holders.values():
        for a in keys:
            for b in keys:
                if a < b:
                    shared[a, b] += 1
    links = {k: set() for k in sets}
    for (a, b), c in shared.items():
        if c >= similarity * (len(sets[a]) + len(sets[b]) - c) - 1e-9:
            links[a].add(b)
            links[b].add(a)
    root = {k: k for k in sets}
    for _ in sets:
        new = {k: min([root[k], *(root[x] for x in links[k])]) for k in root}
        if new == root:
            break
        root = new
    return {k: (root[k], len(links[k])) for k in sets}


def got(frame, key="id"):
    return {r[key]: (r.class_id, r.n_links) for r in frame.collect()}


def near_copies(n, seed=1):
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = f"e{i}x{draw.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op10_ngram_join(spark, "/root/testdata/sf0.001"), "doc_id") == brute([tuple(d) for d in docs])


def test_a_large_group_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "_BLOCK_SETS", 16)
    rows = list(enumerate(near_copies(90) + near_copies(3, 2) * 2 + ["a b", "A  b", "a b c", "", None]))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(ngram_join.ngram_classes(frame)) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    out = ngram_join.ngram_classes(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r.class_id == r.id and r.n_links == 0 for r in out if r.id is not None)
    kept = ngram_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and sorted(i for i in ids if i is not None) == list(range(9)), "null ids stay, repeated ids leave one row"
    assert ngram_join.ngram_classes(no_docs).count() == 0 and ngram_join.one_of_each(no_docs).count() == 0


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999, 0.99999):
        bands, rows = ngram_join.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= 256
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.999999, 4)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7000, 7000), (None, 3)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {7000: 7000}


def test_local_roots():
    import numpy as np

    linked = np.zeros((5, 5), bool)
    for a, b in ((0, 3), (3, 4), (1, 2)):
        linked[a, b] = linked[b, a] = True
    assert blocks.local_roots(linked).tolist() == [0, 1, 1, 0, 0]
