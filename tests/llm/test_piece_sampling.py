import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmix.llm import piece_sampling as ps, queries
from llm_data import DOCS, EDGES, SF

ODD = ["", " ", "\n", "  two  spaces \n\n tab\tx\r\n", "a▁b ▁▁ c▁", "é漢字\U0001F600\U0010FFFF ü\x00", "x" * 3000, " " * 999,
       "word" * 5000, "▁", "<s> </s> <unk> <0x0A>"]


@pytest.fixture(scope="module")
def v():
    return ps.vocabulary()


@pytest.mark.parametrize("text", ODD)
def test_lossless(v, text):
    pieces = ps.segment(["k"], [text], v)[0]
    assert ps.joined(pieces, v) == text
    assert (pieces >= 3).all() and (pieces < len(v.data)).all()


def test_paths_have_the_model_s_probabilities(v):
    """Draws of one word against all of its segmentations, enumerated."""
    word, n = " thereo", 100_000
    logp = {v.data[i]: (int(i), p) for i, p in zip(v.ids, v.logp)}

    def paths(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in logp:
                i, p = logp[rest[:k]]
                for more, q in paths(rest[k:]):
                    yield (i, *more), p + q

    every = dict(paths(word.encode()))
    total = sum(map(math.exp, every.values()))
    owner, piece = ps.Lattice([word], v).draw(np.zeros(n, np.int64), ps._mix(np.arange(n, dtype=np.uint64)))
    cuts = np.searchsorted(owner, np.arange(n + 1))
    drawn = Counter(tuple(piece[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:]))
    assert set(drawn) <= set(every) and len(drawn) >= 5
    for path, p in every.items():
        p = math.exp(p) / total
        assert abs(drawn[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_lattice_against_a_plain_one(v):
    """Forward sums of a plain dynamic program give the shares from which paths are drawn."""
    words = [" hello", "é", "▁x", " \t", "zz漢\U0001F600"]
    lattice = ps.Lattice(words, v)
    spelled = {v.data[i].decode("utf-8", "replace"): p for i, p in zip(v.ids, v.logp)}
    for w, first in zip(words, lattice.first):
        total = [1.0] + [0.0] * len(w)
        for end in range(1, len(w) + 1):
            shares = []
            for begin in range(max(0, end - v.longest), end):
                part = w[begin:end]
                p = spelled.get(part) if ps.MARK not in part else None
                if p is None and len(part) == 1:
                    p = len(part.encode()) * v.byte_logp
                if p is not None:
                    shares.append(total[begin] * math.exp(p))
            total[end] = sum(shares)
            edges = slice(*lattice.edges[[first + end, first + end + 1]])
            below = np.minimum(lattice.below[edges], 1.0)
            assert np.allclose(np.diff(below, prepend=0.0), np.array(shares) / sum(shares), atol=1e-9)


def test_same_key_same_pieces_whatever_the_batch(v):
    texts = ["the quick brown fox " * 20, "jumps over the lazy dog " * 10]
    a, b = ps.segment(["1", "2"], texts, v)
    assert (ps.segment(["2"], texts[1:], v)[0] == b).all() and (ps.segment(["1"], texts[:1], v)[0] == a).all()
    other = ps.segment(["3"], texts[:1], v)[0]
    assert len(other) != len(a) or (other != a).any()


def test_edges(spark, docs):
    rows = EDGES + [(100 + i, t) for i, t in enumerate(ODD) if "\x00" not in t]
    frame = docs(rows, "pieces")
    encoded = ps.encode(frame)
    assert encoded.columns == [c for c in frame.columns if c != "pieces"] + ["pieces"]
    back = ps.decode(encoded).collect()
    assert len(back) == len(rows) and all(r.decoded == r.text for r in back)
    assert all((r.pieces is None) == (r.text is None) for r in back)
    trips = ps.digest(ps.round_trip(frame)).collect()
    assert len(trips) == len(rows) and all(r.lossless for r in trips)
    n = {(r.doc_id, len(r.pieces or ())) for r in back}
    assert n == {(r.doc_id, r.n_pieces) for r in trips}


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert ps.digest(ps.round_trip(none)).collect() == [] and ps.decode(ps.encode(none)).collect() == []


def test_query(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("sha")).collect()
    got = queries.QUERIES["op8_piece_sampling"](spark, SF).collect()
    assert all(r.lossless for r in got) and {(r.doc_id, r.decoded_sha256) for r in got} == {tuple(r) for r in texts}
    again = queries.QUERIES["op8_piece_sampling"](spark, SF).repartition(5).collect()
    assert sorted(got) == sorted(again)
