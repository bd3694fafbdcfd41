import math

import numpy as np
import pytest

from check import compare, connect
from shapeloom.llm import hard_negatives, queries


def long(x):
    return max(-(2**63), min(2**63 - 1, x))


def brute(rows, anchor, positives=5, negatives=3):
    good = {}
    for key, v, label in rows:
        if key is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[key] = (label, [math.floor(256 * x) for x in v])
    out = set()
    for a, (label, v) in good.items():
        if not anchor(a):
            continue
        scores = [(-long(sum(x * y for x, y in zip(v, w))), b, other == label) for b, (other, w) in good.items() if b != a and len(w) == len(v)]
        near = sorted((s, b) for s, b, same in scores if same)[:positives]
        far = sorted((s, b) for s, b, same in scores if not same)
        for s, p in near:
            fits = [(t, b) for t, b in far if 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out |= {(a, p, r, b, -s, -t) for r, (t, b) in enumerate(fits, 1)}
    return out


def got(frame):
    rows = [(r.anchor, r.positive, r.rank, r.negative, r.positive_score, r.negative_score) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def table(seed, n=400, dims=12):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((4, dims))
    rows = [(i, [float(x) for x in centres[i % 4] * draw.uniform(0, 2) + draw.standard_normal(dims) * 0.7], int(draw.integers(4))) for i in range(n)]
    rows += [(n + i, rows[i][1], rows[i + 1][2]) for i in range(0, min(n - 1, 60), 3)]  # equal scores
    return rows


ODD = [
    (-50, None, 1), (-51, [1.0] * 11 + [None], 1), (-52, [float("nan")] * 12, 1), (-53, [float("inf")] * 12, 1), (-54, [1.0] * 12, None), (None, [9.0] * 12, 1),
    (-100, [], 1), (-101, [], 1), (-102, [], 2), (-150, [1.0, 2.0], 1), (-151, [1.0, 2.0], 1), (-152, [1.0, 1.0], 2), (-200, [0.0] * 12, 3),
]
SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("block_bytes, anchors", [(1 << 20, 64), (1500, 4)])
def test_against_all_pairs(spark, monkeypatch, block_bytes, anchors):
    monkeypatch.setattr(hard_negatives, "_BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(hard_negatives, "_ANCHORS", anchors)
    rows = table(3) + ODD
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = got(hard_negatives.mine_negatives(frame, "vec_id % 10 = 0"))
    assert found == brute(rows, lambda i: i % 10 == 0) and len(found) > 100
    twice = frame.union(frame.where("vec_id < 90")).selectExpr("vec_id", "embedding", "label", "1 as dims", "'x' as packed", "2 as block", "3 as asks")
    assert got(hard_negatives.mine_negatives(twice, "vec_id % 10 = 0")) == found


def test_numbers_beyond_64_bits(spark):
    rows = [(0, [1e9, 2e9, 3e9], 1), (1, [1e9, 2e9, 3.1e9], 1), (2, [0.9e9, 1.5e9, 2e9], 2), (3, [-1e9, 1e3, 1.0], 2), (4, [1.0, 2.0, 3.0], 1), (5, [3e6, 1e6, 1e6], 2), (6, [2e6, 1e3, 1.0], 2), (50, [1e300, 0.0, 0.0], 3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for own in (0, 4, 50):
        assert got(hard_negatives.mine_negatives(frame, f"vec_id = {own}")) == brute(rows, lambda i: i == own)


def test_bounds_shrink_the_bitmap():
    draw = np.random.default_rng(1)
    rows = (draw.standard_normal((500, 64)) * 20).astype(np.int16)
    row = {"ids": np.arange(500).tobytes(), "names": ["a"], "codes": np.zeros(500, np.int64).tobytes(), "dims": 64, "columns": np.ascontiguousarray(rows.T).tobytes(), "near": np.zeros(500, np.int64).tobytes()}
    block, sizes = hard_negatives._Block(row), []
    anchor = rows[7].astype(np.int64)
    exact = rows.astype(np.int64) @ anchor
    bar = np.sort(exact)[-5]

    def wanted(least, most):
        sizes.append(len(least))
        return most >= bar

    at, score = block.scan(anchor, np.ones(500, bool), wanted)
    assert set(at) == set(np.flatnonzero(exact >= bar)) and (score == exact[at]).all()
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < 50 and len(sizes) == 8


def test_no_rows(spark):
    frame = spark.createDataFrame(table(5, 30), SCHEMA)
    assert hard_negatives.mine_negatives(frame.limit(0), "vec_id % 10 = 0").count() == 0
    assert hard_negatives.mine_negatives(frame, "false").count() == 0
    assert hard_negatives.mine_negatives(frame.withColumn("vec_id", hard_negatives.F.lit(None).cast("long")), "true").count() == 0


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(queries.op12_hard_negatives(spark, folder), connect(folder), queries.ORACLE["op12_hard_negatives"]) == ""
