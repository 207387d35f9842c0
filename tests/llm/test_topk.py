import math
import random

from pyspark.sql import functions as F

from citygrain.llm import topk


def brute(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, e in ok:
        if q % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(e, f)), i) for i, f in ok if i != q and len(f) == len(e))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def test_against_brute_force(spark):
    r = random.Random(6)
    vector = lambda: [r.choice([-1.0, -0.5, 0.0, 0.25, 1.0, r.uniform(-1, 1)]) for _ in range(4)]
    rows = [(i, vector()) for i in range(220)]
    rows += [(300, [0.0] * 4), (301, rows[0][1]), (302, rows[0][1]), (305, None), (306, [None, 1.0, 1.0, 1.0])]
    rows += [(310, [math.nan, 1.0, 1.0, 1.0]), (311, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0] * 4), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = topk.top_k(table, F.col("vec_id") % 5 == 0, 10, block=50, queries=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_few_and_none(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0]), (5, [1.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(table, F.col("vec_id") % 5 == 0).collect()
    assert [tuple(x) for x in got] == [(0, 1, 1, 3 * 1024 * 1024)]
    assert topk.top_k(table.limit(0), F.col("vec_id") % 5 == 0).collect() == []
    assert topk.top_k(table.where("vec_id = 1"), F.col("vec_id") % 5 == 0).collect() == []
