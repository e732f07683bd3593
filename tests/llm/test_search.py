"""Searches over vectors, against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from milepost.llm import bitsliced, queries, vptree

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0) for i in range(300)]
    rows += [(400 + i, rows[7][1], 0) for i in range(40)]  # many equal ones
    rows += [(500, None, 0), (501, [0.0] * 6, 0), (502, [1.0, None, 0.0, 0.0, 0.0, 0.0], None), (503, [float("nan")] * 6, 0)]
    rows += [(504, [float("inf")] + [0.0] * 5, 0), (505, [1.0, 2.0], 0), (510, [2.0, 2.0], 0), (None, [1.0] * 6, 0), (506, [], 0)]
    rows += [rows[20], rows[20]]
    return spark.createDataFrame(rows, SCHEMA)


def usable(rows, zero):
    """Vectors of each id that takes part: one for each of its rows."""
    out = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if zero or any(v):
            out.setdefault(r.vec_id, []).append(np.array(v, np.float64))
    return out


def brute(found, every, k, score, best):
    """The best pairs of a row with the asked id and a row with another one, as the SQL has them."""
    out = {}
    for q in found:
        pairs = [(score(own, v), i) for own in every[q] for i, group in every.items() if i != q for v in group if len(v) == len(own)]
        out[q] = [(i, s) for s, i in sorted(pairs, key=lambda p: (best * p[0], p[1]))[:k]]
    return out


def check(rows, expected, exact=True):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {q for q, e in expected.items() if e}
    for q, pairs in got.items():
        assert [p[0] for p in pairs] == [e[0] for e in expected[q]]
        assert [p[1] for p in pairs] == pytest.approx([e[1] for e in expected[q]], rel=1e-12)


def test_vantage_points_are_exact_at_factor_one(vectors):
    every = usable(vectors.collect(), zero=False)
    asked = [i for i in every if i % 10 == 0]
    distance = lambda a, b: math.sqrt(((a - b) ** 2).sum())
    found = vptree.nearest(vectors, F.col("vec_id") % 10 == 0, k=10, relaxation=1.0, shard_rows=90, block_rows=8)
    check(found.collect(), brute(asked, every, 10, distance, 1))


def test_vantage_point_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    every = usable(rows, zero=False)
    ids, matrix = np.array(sorted(every)), np.array([every[i][0] for i in sorted(every)])
    hit = total = 0
    for q, group in queries.op3_vantage_points(spark, sf).toPandas().groupby("query_id"):
        away = np.sqrt(((matrix - every[q][0]) ** 2).sum(1))
        away[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, away))[:10]])
        hit += len(best & set(group.vec_id))
        total += 10
        assert group.sort_values("rank").score.is_monotonic_increasing
    assert total == 10 * sum(i % 100 == 0 for i in every) and hit / total >= 0.95


def test_relaxation_skips_more(vectors):
    every = [r for r in vectors.collect() if r.vec_id is not None and r.vec_id < 300]
    rows = {r.vec_id: r.embedding for r in every}
    ids = np.array(sorted(rows))
    points = np.array([rows[i] for i in ids], np.float64)
    tree = vptree.build_tree(ids, points, leaf=8)
    seen = {}
    for factor in (1.0, 3.0):
        count = 0
        inner = vptree.distances

        def counted(a, b, inner=inner):
            nonlocal count
            count += len(a) * len(b)
            return inner(a, b)

        vptree.distances = counted
        try:
            vptree.search_tree(tree, ids[::10], points[::10], 5, factor)
        finally:
            vptree.distances = inner
        seen[factor] = count
    assert seen[3.0] < seen[1.0]


def test_bit_slices_are_exact(vectors):
    scaled = {i: [np.floor(256 * v) for v in group] for i, group in usable(vectors.collect(), zero=True).items()}
    asked = [i for i in scaled if i % 10 == 0]
    product = lambda a, b: int(a @ b)
    found = bitsliced.top_products(vectors, F.col("vec_id") % 10 == 0, k=5, shard_rows=90, block_rows=8)
    check(found.collect(), brute(asked, scaled, 5, product, -1))


def test_bit_slices_against_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    expected = duckdb.sql(queries.oracle_sql()["op4_bit_slices"]).fetchall()
    found = queries.op4_bit_slices(spark, sf).collect()
    assert sorted(map(tuple, found)) == sorted(expected) and len(expected) == 50


def test_weighted_sums_and_selection():
    rng = np.random.default_rng(6)
    for span in (1, 3, 900):
        values = rng.integers(-span, span + 1, (130, 5))
        index = bitsliced.build_slices(np.arange(130), values)
        for weights in (rng.integers(-span, span + 1, 5), np.zeros(5, np.int64)):
            _, found, scores = bitsliced.search_slices(index, np.array([1000]), weights[None, :], 7)
            want = sorted(range(130), key=lambda i: (-(values[i] @ weights), i))[:7]
            assert sorted(found.tolist()) == sorted(want) and (scores == values[found] @ weights).all()


def test_searches_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vptree.nearest(none, F.col("vec_id") % 2 == 0).count() == 0
    assert bitsliced.top_products(none, F.col("vec_id") % 2 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 0)], SCHEMA)
    assert vptree.nearest(alone, F.col("vec_id") % 2 == 0).count() == 0


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(0, [1.0, 0.0], 0), (3, [2.0, 0.0], 0), (3, [5.0, 0.0], 0), (7, [4.0, 0.0], 0)] + [(9, [3.0, 0.0], 0)] * 4
    df = spark.createDataFrame(rows, SCHEMA)
    zero = F.col("vec_id") == 0
    found = bitsliced.top_products(df, zero, k=5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(3, 5 * 256 * 256), (7, 4 * 256 * 256)] + [(9, 3 * 256 * 256)] * 3
    found = vptree.nearest(df, zero, k=3, relaxation=1.0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(3, 1.0), (9, 2.0), (9, 2.0)]
    # own id is no candidate, whichever row of it asks; four equal rows ask, so the best pairs hold 3 four times
    assert {r.vec_id for r in bitsliced.top_products(df, F.col("vec_id") == 9).collect()} == {3, 7}


def test_wide_components_are_exact(spark):
    big = float(2**21)
    rows = [(i, [float(i % 7), -float(i % 5)], 0) for i in range(1, 60)]
    rows += [(100, [big, 1.0], 0), (101, [float(2**40), 0.0], 0), (102, [-1e300, 1.0], 0), (0, [1.0, 0.5], 0), (70, [3.0 * 2**30, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    exact = {i: [int(x) * 256 if abs(x) > 2**53 else math.floor(256 * x) for x in v] for i, v, _ in dict.fromkeys((r[0], tuple(r[1]), 0) for r in rows)}
    for asked in (0, 70):
        clipped = lambda v: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(exact[asked], v))))
        want = [(i, -s) for s, i in sorted((-clipped(v), i) for i, v in exact.items() if i != asked)[:5]]
        found = bitsliced.top_products(df, F.col("vec_id") == asked, shard_rows=20).orderBy("rank").collect()
        assert [(r.vec_id, r.score) for r in found] == want, asked
    # the row found by rank one of the query 0 has a component beyond 2**28
    assert bitsliced.top_products(df, F.col("vec_id") == 0).orderBy("rank").first().vec_id == 101


def test_blocks_are_sent_to_shards_once(spark, vectors):
    """No shard is sent once per block: tiles hold as many queries as rows."""
    plan = bitsliced.top_products(vectors, F.col("vec_id") % 10 == 0)._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and "Join" not in plan
