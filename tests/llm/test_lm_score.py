import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gridmix.llm import lm_score as lm, queries
from llm_data import DOCS, EDGES, SF


def tokens(text):
    out, word = [], ""
    for c in text or "":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c in " \t\n\x0b\x0c\r":
            out, word = (out + [word] if word else out), ""
        else:
            word += c
    return out + ([word] if word else []) + ["END OF TEXT"]


def brute(rows):
    """Counts, weights and scores with dictionaries."""
    crc = lambda i: -1 if i is None else zlib.crc32(str(i).encode())
    held = [i is not None and crc(i) % 7 == 2 for i, _ in rows]
    deleted = [not h and i is not None and crc(i) // 7 % lm.DELETED == 0 for h, (i, _) in zip(held, rows)]
    toks = [tokens(t) for _, t in rows]
    uni, bi, kept_uni, kept_bi = Counter(), Counter(), Counter(), Counter()
    for t, h, d in zip(toks, held, deleted):
        for on, u, b in ((not h, uni, bi), (not h and not d, kept_uni, kept_bi)):
            if on:
                u.update(t)
                b.update(zip([t[-1], *t], t))
    total, vocab, kept = sum(uni.values()), len(uni), sum(kept_uni.values())

    def estimates(t, u, b, n):
        for v, w in zip([t[-1], *t], t):
            c = u[v]
            yield (min(1 + int(math.log2(c)), lm.BUCKETS - 1) if c else 0), (b[v, w] / c if c else 0.0), u[w] / max(1, n)

    weights = np.full((lm.BUCKETS, 3), 1 / 3)
    events = [e for t, d in zip(toks, deleted) if d for e in estimates(t, kept_uni, kept_bi, kept)]
    for _ in range(lm.ITERATIONS):
        sums = np.zeros_like(weights)
        for k, f2, f1 in events:
            p = weights[k] * (f2, f1, 1 / (vocab + 1))
            sums[k] += p / p.sum()
        for k in {e[0] for e in events}:
            weights[k] = (sums[k] + lm.PRIOR) / (sums[k] + lm.PRIOR).sum()
    out = []
    for (i, _), t, h in zip(rows, toks, held):
        base = sum(math.log10((uni[w] + 1) / (total + vocab + 1)) for w in t)
        score = sum(math.log10(weights[k] @ (f2, f1, 1 / (vocab + 1))) for k, f2, f1 in estimates(t, uni, bi, total))
        out.append((str(i), h, len(t), sum(uni[w] > 0 for w in t), total, base, score))
    return sorted(out)


def same(got, want):
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_edges(spark, docs):
    rows = EDGES + [(i, f"the cat {'sat' if i % 3 else 'ran'} on The mat {i % 5}") for i in range(100, 180)]
    same(lm.digest(lm.score(docs(rows, "score"))).collect(), brute(rows))


def test_one_row_and_none(spark, docs):
    assert lm.digest(lm.score(spark.createDataFrame([], DOCS))).collect() == []
    for rows in ([(1, None)], [(14, "only held out")]):  # crc32("14") % 7 is 2
        same(lm.digest(lm.score(docs(rows))).collect(), brute(rows))


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same(queries.QUERIES["op6_lm_score"](spark, SF).collect(), brute(rows))


def test_model_beats_the_base_on_held_out_documents(spark):
    got = [r for r in queries.QUERIES["op6_lm_score"](spark, SF.replace("0.001", "0.01")).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_keys_travel_whole():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        assert (lm._hashes(lm._keys(keys)) == keys).all()
    for values in (np.array([0, 1, 2 ** 40]), np.arange(9), np.empty(0, np.int64)):
        assert (lm._unpack(lm._pack(values), len(values)) == values).all()
