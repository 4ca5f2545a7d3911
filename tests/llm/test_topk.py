from __future__ import annotations

import math
import random

import pytest

from orderlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, q int, b int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1, 2, 3) for i, v in rows], SCHEMA)


def brute(rows, k, every=100):
    clean = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({(i, tuple(v)) for i, v in clean if i % every == 0}):
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in clean if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return out


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(("block", "queries"), [(2048, 1024), (37, 2)])
def test_against_brute_force(spark, block, queries):
    rng = random.Random(block)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.5, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(520)]
    rows = [(i, [float.fromhex(float(x).hex()) for x in v]) for i, v in rows]
    df = frame(spark, rows)
    exact = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert found(topk.top_k(df, 10, block_rows=block, query_rows=queries)) == sorted(brute(exact, 10))


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, []), (3, [None, 1.0]), (4, [math.nan, 1.0]),
            (5, [math.inf, 1.0]), (None, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (100, [-1.0, 0.0])]
    got = found(topk.top_k(frame(spark, rows), 3))
    assert got == sorted(brute(rows, 3))
    assert [r[2] for r in got if r[0] == 0] == [6, 7, 7]
    assert found(topk.top_k(frame(spark, rows).limit(0), 3)) == []
    assert found(topk.top_k(frame(spark, [(0, [1.0])]), 3)) == []


def test_queries_are_dealt_by_their_ids_alone(spark, monkeypatch):
    """Whatever order a task reads the queries in, also when it is run again."""
    seen, pack = [], topk.packed
    monkeypatch.setattr(topk, "packed", lambda df, rows, key, **how: seen.append((df, rows, key, how)) or pack(df, rows, key, **how))
    topk.top_k(frame(spark, [(100 * i, [float(i), 1.0]) for i in range(60)]), 2, query_rows=7)
    (queries, rows, _, how), _ = seen
    orders = queries.repartition(1).sortWithinPartitions("id"), queries.repartition(5).sortWithinPartitions("v")
    blocks = [{i: r.q for r in pack(df, rows, "q", **how).collect() for i in r.q_ids} for df in orders]
    assert blocks[0] == blocks[1] and len(blocks[0]) == 60 and len(set(blocks[0].values())) > 1


def test_large_values_stay_exact(spark):
    rows = [(0, [3e4, 2.0**20]), (1, [2.0**20, 1.0]), (2, [2.0**20, 2.0]), (3, [-(2.0**20), 2.0**18])]
    assert found(topk.top_k(frame(spark, rows), 2)) == sorted(brute(rows, 2))


def test_one_query_id_with_two_vectors_is_refused(spark):
    with pytest.raises(Exception, match="several vectors"):
        topk.top_k(frame(spark, [(0, [1.0]), (0, [2.0])]), 2).collect()
