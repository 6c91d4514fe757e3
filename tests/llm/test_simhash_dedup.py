import itertools
import random

import numpy as np
import pytest
import xxhash

from llm_data import DOCS, EDGES, SF
from gridmix.llm import common, queries, simhash_dedup as sd


def brute_fp(text):
    words, word = [], ""
    for c in (text or ""):
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c in " \t\n\x0b\x0c\r":
            words, word = (words + [word] if word else words), ""
        else:
            word += c
    words += [word] if word else []
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute(rows, bits=4):
    fps = [brute_fp(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits and label[i] != label[j]:
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
    least = {}
    for (i, _), l in zip(rows, label):
        if i is not None:
            least[l] = min(least.get(l, i), i)
    return sorted((i if i is not None else -1, f"{f:016x}", least.get(l, -1)) for (i, _), f, l in zip(rows, fps, label))


def got(frame, **k):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id if r.component_id is not None else -1)
                  for r in sd.digest(sd.near_duplicates(frame, **k)).collect())


def test_edges(spark, docs):
    near = "the quick brown fox jumps over the lazy dog again and again until it rests " * 9
    rows = EDGES + [(30, near), (31, near + "x"), (32, "Q " + near), (33, "z z nbsp is no space")]
    assert got(docs(rows, "fp")) == brute(rows)


def test_empty(spark):
    assert got(spark.createDataFrame([], DOCS)) == []


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.QUERIES["op2_simhash_dedup"](spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == brute(rows)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_cells_miss_no_pair(bits):
    rng = np.random.default_rng(bits)
    x = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    y = x.copy()
    for _ in range(bits):
        y ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    assert (sd.manhattan(x, y) <= np.bitwise_count(x ^ y)).all()
    assert (sd.manhattan(x, y) == np.abs(sd.embed(x) - sd.embed(y)).sum(axis=1)).all()
    kx, ox = sd.cells(x, bits)
    ky, oy = sd.cells(y, bits)
    mine = [set() for _ in range(300)]
    for k, o in zip(kx, ox):
        mine[o].add(k)
    met = {o for k, o in zip(ky, oy) if k in mine[o]}
    assert met == set(range(300))


def test_dense_cells_are_dealt_out(spark):
    """A dense ball of fingerprints: small limits give the components of brute force."""
    rng = random.Random(3)
    fps = {0}
    while len(fps) < 400:
        fps.add(sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))))
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    pairs = {(r.node, r.root) for r in common.connected_components(sd.links(nodes, 4, 8)).collect()}
    whole = {(r.node, r.root) for r in common.connected_components(sd.links(nodes, 4)).collect()}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    u = np.array(fps, dtype=np.int64).view(np.uint64)
    label = {f: f for f in fps}
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i] ^ u) <= 4):
            a, b = label[fps[i]], label[fps[j]]
            if a != b:
                label = {f: min(a, b) if l in (a, b) else l for f, l in label.items()}
    want = {(f, l) for f, l in label.items() if list(label.values()).count(l) > 1}
    assert pairs == whole == want


def test_keep_one(spark, docs):
    rows = EDGES + [(None, "a b c d e f g h"), (5, "a b c d e f g h"), (5, "the same id with other words in it")]
    frame = docs(rows, "key_")
    kept = sd.keep_one(frame)
    assert kept.columns == frame.columns
    ids = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted((i if i is not None else -1) for i, _ in ids) == [-1, 1, 4, 5, 5, 7, 8]


def test_components_of_a_hub(spark):
    links = spark.createDataFrame([(1000, i) for i in range(1001, 1200)] + [(5, 1100), (2000, 2001), (3, 3)], "a long, b long")
    out = {r.node: r.root for r in common.connected_components(links).collect()}
    assert out == {**{i: 5 for i in [5, *range(1000, 1200)]}, 2000: 2000, 2001: 2000}


def test_dealt_join_is_a_join_whatever_the_salt(spark):
    rows = spark.createDataFrame([(k, i) for k, n in (("a", 50), ("b", 1), (None, 2)) for i in range(n)] + [("c", None)], "k string, i int")
    per_key = spark.createDataFrame([("a", 1), ("c", 2), ("d", 3)], "k string, v int")
    for how in ("inner", "left"):
        got = common.dealt_join(rows, per_key, "k", "i", how).select("k", "i", "v").collect()
        assert sorted(got, key=str) == sorted(rows.join(per_key, "k", how).select("k", "i", "v").collect(), key=str)
