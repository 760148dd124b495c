import math

import numpy as np
import pytest
from pyspark.sql import Row

from catalogsync.llm import topk_search as K


def plain(rows, k=5):
    """All inner products, the best first."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in rows:
        if i is not None and i % 50 == 0 and (i, [math.floor(256 * x) for x in v] if v and None not in v and all(map(math.isfinite, v)) else v) in good:
            asked[i] = min(asked.get(i, v), v)
    for i, v in asked.items():
        q = [math.floor(256 * x) for x in v]
        scored = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in good if j != i)
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(spark, rows, **options):
    df = spark.createDataFrame([Row(vec_id=i, embedding=v, score=1, rank="r", query_id=None, vector="x") for i, v in rows],
                               "vec_id long, embedding array<float>, score int, rank string, query_id int, vector string")
    return sorted(tuple(r) for r in K.top_k(df, "vec_id % 50 = 0", **options).select("query_id", "rank", "vec_id", "score").collect())


def as_float(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("kind", ["random", "clusters", "ties"])
def test_against_all_products(spark, kind, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 150)
    monkeypatch.setattr(K, "QUERY_BLOCK", 4)
    random = np.random.default_rng(4)
    vectors = random.normal(0, 0.2, (700, 16))
    if kind == "clusters":
        vectors += random.normal(0, 1, (5, 16))[random.integers(0, 5, 700)]
    if kind == "ties":
        vectors = random.integers(-1, 2, (700, 16)) / 4.0
    rows = as_float(enumerate(vectors.tolist()))
    assert search(spark, rows) == plain(rows)


def test_cases(spark):
    rows = as_float([
        (0, [1.0, -2.0, 0.5]), (1, [0.1, 0.2, 0.3]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]),
        (5, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (6, [0.5]), (7, []), (8, [0.1, 0.2, 0.3, 9.0]), (1, [0.1, 0.2, 0.3]),
        (50, [2.0, 2.0, 2.0]), (100, None), (50, [2.0, 2.0, 1.0]), (150, [-0.001, 0.0, 1e6]),
    ])
    assert search(spark, rows) == plain(rows)
    assert search(spark, rows[:2]) == plain(rows[:2])
    assert search(spark, []) == []
    assert search(spark, rows[1:2]) == []


def test_large_components_score_exactly(spark):
    """Components of 2 ** 21 and more, also where single products of a sum leave the range of a long."""
    big = 2.0**21
    rows = as_float([(0, [big, 1.0, 0.0])] + [(k, [big * k, -k / 256, 1.0]) for k in range(1, 30)])
    assert search(spark, rows) == plain(rows)
    # 2 ** 38 * 2 ** 48 and its opposite cancel; what is left fits a long.
    rows = as_float([(50, [2.0**30, -(2.0**30), 3.0]), (60, [2.0**20, 2.0**20, -1.0])] + [(60 + k, [2.0**40, 2.0**40, k / 4]) for k in range(1, 9)])
    found = search(spark, rows)
    assert found == plain(rows) and found[0] == (50, 1, 68, 768 * 512)


def test_scores_beyond_a_long_are_held(spark):
    least, most = -(1 << 63), (1 << 63) - 1
    found = search(spark, [(0, [3e38, 1.0]), (1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 2.0]), (4, [-3e38, -1.0]), (5, [2e38, 9.0])])
    assert found == [(0, 1, 1, most), (0, 2, 5, most), (0, 3, 3, 2 << 16), (0, 4, 2, least), (0, 5, 4, least)]
    few = search(spark, [(0, [3e38, 1.0]), *[(k, [-3e38, 0.0]) for k in range(9, 0, -1)]])
    assert [r[2:] for r in few] == [(k, least) for k in range(1, 6)]


def test_early_rounds_prove_on_clusters():
    """On clustered vectors most queries stop before all segments are processed."""
    random = np.random.default_rng(8)
    values = K.quantised((random.normal(0, 0.02, (600, 16)) + random.normal(0, 1, (30, 16))[random.integers(0, 30, 600)]).tolist())
    block, ids = K.Block(np.arange(600), values), np.arange(0, 600, 10)
    rounds = []
    original = block._round

    def counted(left, share, *rest):
        rounds.append((share, len(left)))
        return (yield from original(left, share, *rest))

    block._round = counted
    found = list(block.search(ids, values[::10], 5))
    assert len(found) == 60 and sum(n for s, n in rounds if s == 1.0) < 30
