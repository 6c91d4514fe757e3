import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gridmix.llm import queries, token_alignment as ta
from llm_data import EDGES, SF

MORE = [(20, "<|endoftext|> and <s>, <unk>"), (21, "a▁b"), (22, "tabs\tand\r\n\n  spaces   "), (23, " leading"),
        (24, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"), (25, "\U0001F600\U0001F601 é\x00\x07 ﬁ"),
        (26, "<0x41> A"), (27, "the cat sat on the mat"), (28, "the cat sat"), (28, "the cat sat")]


def tokens(text):
    """Both sides as (id, start, end), and the bytes, by plain loops; None where they differ."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(ta.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.PIECES)
    data = b" " + text.encode()
    pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    theirs = [(i, bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
    enc = a.encode(" " + text, add_special_tokens=False)
    table = {c: n for c, n in ta._byte_alphabet().items()}
    ours = [(i, bytes(table[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
    out = []
    for side in (ours, theirs):
        if b"".join(x for _, x in side) != data:
            return None
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def brute(rows):
    """Per row the contract's columns, by pairwise comparison inside windows."""
    each = []
    for id, text in rows:
        sides = tokens(text) if text else None
        if not sides:
            each.append((id, 0, 0, 0, [], "", 0))
            continue
        a, b = sides
        links, j = [], 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts = {g: ([], []) for g in range(len(ends))}
        for n, side in enumerate((a, b)):
            for i, s, e in side:
                parts[bisect.bisect_left(ends, e)][n].append(str(i))
        n_shared = sum(len(x) * len(y) for x, y in parts.values())
        said = ";".join(",".join(x) + "|" + ",".join(y) for x, y in parts.values())
        each.append((id, len(a), len(b), len(ends), links, hashlib.sha256(said.encode()).hexdigest(), n_shared))
    count = Counter(p for e in each for p in set(e[4]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((id, n_a, n_b, g, len(ls), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls), sha, shared)
                   for id, n_a, n_b, g, ls, sha, shared in each), key=str)


def got(frame):
    return sorted((tuple(r) for r in ta.digest(frame).collect()), key=str)


def test_edges(spark, docs):
    rows = EDGES[:8] + MORE
    assert got(ta.align(docs(rows, extra="block"))) == brute(rows)


def test_long_text_and_many_blocks(spark, docs):
    rows = [(1, EDGES[8][1][:60_000]), (2, "x" * 3000), (3, "=" * 5000 + " a"), *MORE]
    want = brute(rows)
    assert got(ta.align(docs(rows).repartition(3))) == want


def test_small_runs_give_the_same(spark):
    """Blocks, chunks and runs of any size."""
    tool = ta.Aligner(*(open(ta.BYTE_BPE).read(), open(ta.PIECES, "rb").read()))
    texts = [t for _, t in MORE]
    whole = tool.align(texts)
    a, b = whole.over_bytes
    for bound in (1, 7, 50):
        runs = list(ta.multiply(a, ta.transpose(b), bound))
        assert len(runs) > 1
        for one, all_ in zip(zip(*runs), zip(*whole.links())):
            assert np.array_equal(np.concatenate(one), np.concatenate(all_))


def test_chunks_are_whole_texts():
    """Encoding chunk by chunk is encoding the text."""
    tool = ta.Aligner(*(open(ta.BYTE_BPE).read(), open(ta.PIECES, "rb").read()))
    rng = random.Random(4)
    some = ["a", "B", "é", " ", " ", "  ", "\n", "\t", "\r\n", ".", "'s", "'", "12", "3", "\u00a0", "\u3000", "\u2028", "\x1c", "\x85",
            "\u200b", "-", "word", "<s>", "\U0001F600", "\ufeff", "e\u0301", "\u180e"]
    texts = [t for _, t in MORE + EDGES if t and "▁" not in t] + ["".join(rng.choices(some, k=rng.randint(1, 30))) for _ in range(3000)]
    for side, whole in zip(("a", "b"), tool.encode(texts)):
        for text, ids in zip(texts, whole):
            parts = tool.encode(ta.chunks(text))[side == "b"]
            assert "".join(" " + c for c in ta.chunks(text)) == " " + text
            assert [i for p in parts for i in p] == ids


def test_products_are_matrix_products():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x, y = rng.integers(0, 3, (7, 9)) * (rng.random((7, 9)) < .4), rng.integers(0, 3, (9, 5)) * (rng.random((9, 5)) < .4)
        sparse = []
        for m in (x, y):
            r, c = np.nonzero(m)
            sparse.append(ta.Csr(np.searchsorted(r, np.arange(len(m) + 1)), c, m[r, c], m.shape[1]))
        out = np.zeros((7, 5), int)
        for r, c, v in ta.multiply(*sparse, bound=4):
            out[r, c] += v
        assert np.array_equal(out, x @ y)
        t = ta.transpose(sparse[0])
        assert np.array_equal(ta.transpose(t).indices, sparse[0].indices) and t.rows == 9


@pytest.mark.parametrize("kind", ["overlap", "group"])
def test_links(spark, docs, kind):
    rows = [(i, t) for i, t in MORE if i != 28]
    want = []
    for id, text in rows:
        a, b = tokens(text) or ([], [])
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        for n, (i, s, e) in enumerate(a):
            for m, (j, t, f) in enumerate(b):
                shared = max(0, min(e, f) - max(s, t))
                if kind == "group":
                    shared = int(not any(min(e, f) <= x < max(e, f) for x in ends))
                if shared:
                    want.append((id, n, m, i, j, shared))
    assert sorted(tuple(r) for r in ta.links(docs(rows), kind).collect()) == sorted(want)


def test_empty(spark, docs):
    assert got(ta.align(docs([]))) == []
    assert got(ta.align(docs([(1, None), (None, "")]))) == sorted([(1, *[0] * 6, "", 0), (None, *[0] * 6, "", 0)], key=str)


def test_query(spark):
    """Whole table against plain loops."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.QUERIES["op11_token_alignment"](spark, SF).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows)
    assert sum(r.n_links for r in out) > 10_000 and len({r.doc_id for r in out}) == len(rows)
