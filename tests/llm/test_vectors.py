import numpy as np
import pytest

from shapeloom.llm import queries, vectors


def brute(rows, similarity=0.98):
    out = {}
    good = {}
    for key, v, label in rows:
        ok = label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            good.setdefault((label, len(v)), []).append((key, np.array(v, float) / np.linalg.norm(v)))
        else:
            out[key] = (0, key)
    for members in good.values():
        ids = np.array([k for k, _ in members])
        unit = np.stack([v for _, v in members])
        linked = unit @ unit.T >= similarity
        np.fill_diagonal(linked, False)
        root = ids.copy()
        while True:
            new = np.minimum(root, np.where(linked, root[None, :], 1 << 60).min(1))
            if (new == root).all():
                break
            root = new
        out |= {int(k): (int(n), int(r)) for k, n, r in zip(ids, linked.sum(1), root)}
    return out


def got(frame, key="id"):
    return {r[key]: (r.n_links, r.component_id) for r in frame.collect()}


def test_dense_groups_copies_and_broken_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "_BLOCK", 32)
    draw = np.random.default_rng(2)
    rows = []
    for label in (0, 1, 2):
        centre = draw.standard_normal(16)
        rows += [(centre + 0.06 * draw.standard_normal(16), label) for _ in range(100)]
        rows += [(draw.standard_normal(16), label) for _ in range(150)]
        rows += [(centre * 2, label), (centre, label), (centre, label)]
    rows += [(draw.standard_normal(8), 0), (rows[0][0], None)]
    table = [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]
    table += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, [float("nan")] * 16, 1), (905, [float("inf")] * 16, 1), (906, [1e300] * 16, 1)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").repartition(3)
    assert got(vectors.near_vectors(frame)) == brute(table)
    assert vectors.near_vectors(frame.limit(0)).count() == 0
    twice = frame.union(frame.where("vec_id < 5")).withColumnRenamed("label", "l").withColumnRenamed("l", "label")
    assert got(vectors.near_vectors(twice)) == brute(table)


def test_null_ids(spark):
    frame = spark.createDataFrame([(None, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, label int")
    assert {(r.id, r.n_links, r.kept) for r in vectors.near_vectors(frame).collect()} == {(None, 0, None), (1, 0, True)}


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(queries.op8_embedding_near_dedup(spark, folder), "vec_id") == brute(table)


def test_passes_grow_with_the_depth():
    few, many = (vectors.passes_at(depth, 0.98, 0.99999) for depth in (6, 30))
    assert 1 < few < many < 100


def cone(draw, n, pairs, mutual, size=64):
    """Unit vectors at about this cosine to each other, and for the first ``pairs`` one at 0.982 in the same cone."""
    axis = np.eye(size)[0]
    side = draw.standard_normal((n, size))
    side[:, 0] = 0
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    rows = np.sqrt(mutual) * axis + np.sqrt(1 - mutual) * side
    aside = draw.standard_normal((pairs, size))
    aside[:, 0] = 0
    aside -= (aside * side[:pairs]).sum(1, keepdims=True) * side[:pairs]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    c = (0.982 - mutual) / (1 - mutual)
    return np.concatenate([rows, np.sqrt(mutual) * axis + np.sqrt(1 - mutual) * (c * side[:pairs] + np.sqrt(1 - c * c) * aside)])


@pytest.mark.parametrize(("mutual", "small"), [(0.0, False), (0.90, False), (0.95, False), (0.90, True), (0.94, True)])
def test_cones_lose_no_pair(spark, monkeypatch, mutual, small):
    """Labels of many windows whose vectors lie evenly or all close together; with small pieces long runs are cut into blocks."""
    if small:
        depths = vectors._DEPTHS if mutual < 0.92 else range(6, 7, 3)
        for name, value in (("_WINDOW", 64), ("_ROW_COST", 16), ("_CELL", 300), ("_DEPTHS", depths)):
            monkeypatch.setattr(vectors, name, value)
    units = cone(np.random.default_rng(7), 4000, 400, mutual)
    table = [(i, v.tolist(), 1) for i, v in enumerate(units)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").repartition(4)
    distinct = frame.selectExpr("cast(label as string) label", "embedding v", "vec_id rep", "size(embedding) size")
    plan = vectors._plan(distinct, 0.98, 0.99999, 23).first()
    assert plan.depth >= 6 and plan.passes == vectors.passes_at(plan.depth, 0.98, 0.99999) > 1
    assert got(vectors.near_vectors(frame)) == brute(table)


def test_windows_link_neighbours_across_batches(monkeypatch):
    """Rows near each other in the order are linked although their runs differ; those farther than a window are not."""
    monkeypatch.setattr(vectors, "_WINDOW", 8)
    monkeypatch.setattr(vectors, "_CELL", 16)
    draw = np.random.default_rng(5)
    rows = draw.standard_normal((60, 8))
    rows[21], rows[40] = rows[15], rows[10]
    columns = {"pass": np.zeros(60, np.int32), "label": ["a"] * 60, "size": np.full(60, 8, np.int32), "key": np.arange(60), "order": np.arange(60), "rep": np.arange(60), "v": rows.tolist()}
    table = vectors.pa.table(columns)
    batches = [b for k in (0, 7, 19, 30) for b in table.slice(k, {0: 7, 7: 12, 19: 11, 30: 30}[k]).combine_chunks().to_batches()]
    found = {frozenset((r["a"], r["b"])) for b in vectors._compare_windows(0.999)(iter(batches)) for r in b.to_pylist()}
    assert found == {frozenset((15, 21))}
    columns["key"] = np.zeros(60, np.int64)
    monkeypatch.setattr(vectors, "_CELL", 64)
    batches = vectors.pa.table(columns).to_batches(max_chunksize=13)
    found = {frozenset((r["a"], r["b"])) for b in vectors._compare_windows(0.999)(iter(batches)) for r in b.to_pylist()}
    assert found == {frozenset((15, 21)), frozenset((10, 40))}, "a run is compared whole"
