import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from gridmix.llm import count_transducer as ct, phrase_mining as pm, queries
from llm_data import EDGES, SF

SCHEMA = "doc_id long, text string, lang string, score string"


def brute_counts(rows):
    f = Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f


def brute(rows, top=2000, least=10):
    f, out, n, longer = brute_counts(rows), [], Counter(), Counter()
    for (lang, w), c in f.items():
        n[lang] += c * (len(w) == 1)
        if len(w) == 3 and c >= least:
            for inside in (w[:2], w[1:]):
                longer[lang, inside] = max(longer[lang, inside], c)
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least or (longer[lang, w] and 100 * longer[lang, w] >= 50 * a):
            continue
        s, k = min((10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], s))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(o[0], r + 1, *o[1:]) for r, o in enumerate(own[:top])]
    return sorted(ranked)


def text(rng, n, words=12):
    """Few words, so that phrases repeat; pieces of any length."""
    w = [f"w{i}" for i in range(words)] + ["İx", "A", "É"]
    weights = [2.0 ** -i for i in range(len(w))]
    return "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!?"]) for x in rng.choices(w, weights, k=n))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def got(frame):
    return sorted(tuple(r) for r in pm.digest(frame).collect())


@pytest.fixture()
def rows():
    rng = random.Random(5)
    out = [(i, text(rng, rng.randint(0, 200)), rng.choice(["en", "en", "de", None, "und", ""])) for i in range(120)]
    return out + [(i, t, "fr") for i, t in EDGES] + out[:3]


def test_edges(spark, rows):
    want = brute(rows)
    assert got(table(spark, rows)) == want and len(want) > 150


def test_many_ranges_and_shards(spark, rows):
    """Ranges that begin inside a word, and slices of many shards, give the same."""
    want = brute(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        frame = table(spark, rows).repartition(7)
        found, words = pm.mine(frame, range_bytes=2000)
        out = pm.top(pm.outermost(found), words).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        assert sorted(tuple(r) for r in out.collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_top_and_empty(spark, rows):
    found, words = pm.mine(table(spark, rows))
    few = pm.top(pm.outermost(found), words, 3).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r) for r in few.collect()) == brute(rows, 3)
    assert got(table(spark, [])) == [] and got(table(spark, [(1, None, None), (2, " .\n", "en")])) == []


def test_score_is_exact():
    a, left, right = 9_999_999_967, 9_999_999_999_971, 9_999_999_999_973
    assert pm.score(np.array([a]), np.array([left]), np.array([right]))[0] == 10 ** 6 * a * a // (left * right)
    assert pm.score(np.array([7, 2]), np.array([9, 5]), np.array([11, 3])).tolist() == [10 ** 6 * 49 // 99, 10 ** 6 * 4 // 15]


def some_levels(rng, n=300, words=6):
    vocabulary = sorted(f"w{i}".encode() for i in range(words))
    tokens = np.array(rng.choices(range(-1, words), k=n), np.int64)
    return ct.from_tokens(tokens, vocabulary, 3)


def as_dict(levels):
    return {tuple(levels.vocabulary[i] for i in row): c for k in range(len(levels.word))
            for row, c in zip(levels.words(k).tolist(), levels.count[k].tolist())}


def test_automata_keep_their_phrases_and_are_minimal():
    rng = random.Random(2)
    for n in (0, 1, 5, 40, 300, 2000):
        levels = some_levels(rng, n)
        want = as_dict(levels)
        assert as_dict(ct.unpack(ct.pack(levels))) == want
        # states by what can follow, with the counts that it adds
        below = {}
        for p, c in sorted(want.items(), key=lambda x: -len(x[0])):
            below.setdefault(p, {})
            below.setdefault(p[:-1], {})[p[-1]] = (c - want.get(p[:-1], 0), tuple(sorted(below[p].items())))
        kinds = {tuple(sorted(b.items())) for b in below.values()} | {()}
        assert len(np.diff(ct.build(levels).offset)) == len(kinds) + (n == 0 and 1)


def test_union_and_compose():
    rng = random.Random(3)
    for _ in range(10):
        some = [some_levels(rng, rng.randint(0, 200), rng.randint(1, 8)) for _ in range(4)]
        want = sum((Counter(as_dict(s)) for s in some), Counter())
        whole = ct.union(some)
        assert as_dict(whole) == want
        kept = as_dict(ct.at_least(whole, 5))
        assert kept == {p: c for p, c in want.items() if c >= 5}
        groups = [np.array([[0, 1]]), np.array([[0], [2]]), np.array([[2, 0, 1], [0, 1, 2]])]
        asked, places = ct.from_phrases(groups, sorted([b"w0", b"w1", b"zz"]))
        found = ct.compose(asked, whole)
        for g, at in zip(groups, places):
            for row, x in zip(g, at):
                assert found.count[len(row) - 1][x] == want[tuple([b"w0", b"w1", b"zz"][i] for i in row)]


def test_ranges_hold_each_phrase_once():
    rng = random.Random(4)
    for _ in range(20):
        levels = some_levels(rng, 200)
        ends = [b"", *levels.vocabulary, b"w", b"zz"]
        cuts = sorted({(rng.choice(["a", "b", "c"]), rng.choice(ends[1:]), rng.choice(ends)) for _ in range(9)})
        seen = Counter()
        for r, part in ct.ranges(levels, "b", cuts):
            for p, c in as_dict(part).items():
                key = ("b", p[0], p[1] if len(p) > 1 else b"")
                here = (r == 0 or cuts[r - 1] <= key) and (r == len(cuts) or key < cuts[r])
                assert here or c == 0
                seen[p] += c
        assert +seen == as_dict(levels)


def test_long_texts_are_split_at_marks(monkeypatch):
    monkeypatch.setattr(pm, "SPLIT_BYTES", 50)
    rng = random.Random(6)
    t = text(rng, 500)
    lists = list(pm.split(t))
    assert len(lists) > 5 and all(x[-1] == b"\xff" for x in lists[:-1])
    monkeypatch.undo()
    assert [w for x in lists for w in x] == [w for x in pm.split(t) for w in x]


def test_query_matches_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    res = c.execute(pm.ORACLE)
    cols = [d[0] for d in res.description]
    rows = queries.QUERIES["op13_phrase_mining"](spark, SF).collect()
    assert sorted(tuple(r[c] for c in cols) for r in rows) == sorted(res.fetchall())
    assert len(rows) > 100
