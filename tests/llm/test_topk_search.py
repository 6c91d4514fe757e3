import math
import random

import duckdb
import numpy as np

from llm_data import SF
from gridmix.llm import queries, topk_search as tk

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok = [(i, list(v)) for i, v in {(i, tuple(v)) for i, v in ok}]
    out = []
    for q, v in ok:
        if q % every == 0:
            s = {(-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q}
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(sorted(s)[:k])]
    return sorted(out)


def got(frame, **k):
    return sorted(tuple(r) for r in tk.top_k(frame, **k).collect())


def test_edges(spark):
    rng = random.Random(1)
    grid = [x / 8 for x in range(-8, 9)]  # many ties
    rows = [(i, [rng.choice(grid) for _ in range(6)]) for i in range(300)]
    rows += [(301, None), (302, [1.0, None]), (303, [float("nan"), 1.0]), (304, [float("inf")]), (305, []),
             (350, [0.5]), (None, [1.0] * 6), rows[7], (400, [0.0] * 6), (450, [300.0, -2000.0, 5.0])]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    want = brute([(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert got(frame) == want
    assert got(frame, group=1, tile=2) == want


def test_few_and_none(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, [1.0], 0, "x")], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, [1.0], 0, "x"), (1, [2.0], 0, "x")], SCHEMA)) == [(0, 1, 1, 256 * 512)]


def test_blocks_are_pruned():
    """Where blocks differ, bounds leave most of them out, and the result is whole."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(64, 16)) * 100
    m = np.floor(np.repeat(centres, 32, axis=0) + rng.normal(size=(2048, 16)) * 5)
    ids, none = np.arange(2048), np.full(20, -np.inf)
    q, s, i, scored = tk.search(m[:20], ids[:20], none, m, ids, 5, block=32)
    full = m[:20] @ m.T
    full[np.arange(20), np.arange(20)] = -np.inf
    for n in range(20):
        assert sorted(s[q == n])[::-1] == sorted(full[n])[::-1][:5]
    assert scored < 20 * 64 / 4


def test_query_matches_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = sorted(c.execute(tk.ORACLE).fetchall())
    rows = queries.QUERIES["op4_topk_search"](spark, SF).collect()
    assert sorted(tuple(r) for r in rows) == want and len(want) > 0
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert want == brute(table)
