import math
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millsheet.llm import topn
from millsheet.llm.topn import ordered_bits, top_n

SCHEMA = "doc string, field string, score double, ord int, id long, grp string"


def _run(df, n=3):
    return {(r.id, r.rank_no) for r in top_n(df, [F.col("doc"), F.col("field")], F.col("score"), F.col("ord"), F.col("id"), n).collect()}


def _brute(rows, n=3):
    groups = {}
    for d, f, s, o, i, *_ in rows:
        if d is not None and f is not None and s is not None and not math.isnan(s) and i is not None:
            groups.setdefault((d, f), set()).add((-s + 0.0, o if o is not None else 2**63 - 1, i))
    return {(x[2], k) for g in groups.values() for k, x in enumerate(sorted(g)[:n], 1)}


@given(st.lists(st.floats(allow_nan=False)))
@settings(max_examples=50, deadline=None)
def test_bits_keep_order(xs):
    b = ordered_bits(np.array(xs, float))
    for i in range(len(xs)):
        for j in range(len(xs)):
            assert (xs[i] < xs[j]) == (b[i] < b[j])


def test_bisect_against_sorting():
    rng = np.random.default_rng(0)
    for t in range(200):
        n = int(rng.integers(1, 120))
        g, p, i = rng.integers(0, 6, n), rng.integers(-2, 4, n), rng.permutation(n)
        s = rng.choice([0.1, 0.2, -0.3, 0.0, 1e300, -1e300], n) if t % 2 else rng.random(n)
        got = topn._best(pa.array([str(x) for x in g]), s, p, i, 3)
        want = {x for k in set(g) for _, _, x in sorted((-s[j] + 0.0, p[j], i[j]) for j in range(n) if g[j] == k)[:3]}
        assert {int(i[j]) for j in got} == want


def test_nulls_ties_repeats_and_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot", "f", rng.choice([0.5, 0.9, 0.9]), rng.choice([None, 1, 2]), k, "clash") for k in range(3000)]
    rows += [(f"d{k % 200}", rng.choice(["a", "b"]), rng.random(), 0, 5000 + k, None) for k in range(900)]
    rows += [(None, "f", 1.0, 0, 1, None), ("x", None, 1.0, 0, 2, None), ("x", "f", None, 0, 3, None), ("x", "f", math.nan, 0, 4, None), ("x", "f", 0.1, 0, None, None)] + rows[:50]
    assert _run(spark.createDataFrame(rows, SCHEMA).repartition(3)) == _brute(rows)
    assert _run(spark.createDataFrame([], SCHEMA)) == set()


def test_chunks_that_divide_a_group(spark, monkeypatch):
    rows = [("hot", "f", k / 10, 0, k, None) for k in range(1000)] + [("z", "f", 0.5, 0, 2000 + k, None) for k in range(5)]
    batches = [pa.record_batch({"grp": ["hot"] * 100, "score": [float(k + 100 * b) for k in range(100)], "pos": [0] * 100, "id": [k + 100 * b for k in range(100)]}, schema=pa.schema([("grp", pa.string()), ("score", pa.float64()), ("pos", pa.int64()), ("id", pa.int64())])) for b in range(10)]
    monkeypatch.setattr(topn, "CHUNK", 150)
    out = [r for b in topn._searcher(3, whole=True)(iter(batches)) for r in b.to_pylist()]
    assert out == [{"id": 999, "rank_no": 1}, {"id": 998, "rank_no": 2}, {"id": 997, "rank_no": 3}]
    assert _run(spark.createDataFrame(rows, SCHEMA)) == _brute(rows)
