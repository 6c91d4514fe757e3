import hashlib
import statistics
import time

import pytest

from gridmix.llm import imatch as im, queries
from llm_data import DOCS, EDGES, SF


def brute(rows):
    """Order, edited texts and likenesses, row by row."""
    texts = [(i, t or "") for i, t in rows]
    order = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    n = len(order)
    df = {}
    for _, t in order:
        for w in set(t.encode().lower().split()):
            df[w] = df.get(w, 0) + 1
    words = sorted(w for w, c in df.items() if max(im.LEAST, n / im.RARE) <= c <= n / im.COMMON)
    out = []
    f = im.Fingerprinter(words)
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % n][1]
        third = len(t) // 3
        edited = t[:len(t) - third] + nxt[:third]
        out.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), ",".join(f(t)), ",".join(f(edited)),
                    im.likeness(f(t), f(edited)), im.likeness(f(t), f(nxt))))
    return sorted(out)


def rows_of(got):
    return sorted((str(r.doc_id), *tuple(r)[1:]) for r in got)


def test_edges(spark, docs):
    rows = EDGES + [(i, f"alpha{i % 9} beta{i % 7} gamma{i} the rest of it {'x' * i}") for i in range(100, 160)]
    assert rows_of(im.digest(im.compare(docs(rows, "span"))).collect()) == brute(rows)


def test_one_row_and_none(spark, docs):
    assert im.digest(im.compare(spark.createDataFrame([], DOCS))).collect() == []
    for rows in ([(1, "abcdef")], [(None, None)], [(2, "abc def ghi"), (2, "abc def ghi")]):
        assert rows_of(im.digest(im.compare(docs(rows))).collect()) == brute(rows)


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_query_against_brute_force(spark, parts):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = queries.QUERIES["op7_imatch"](spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows_of(got) == brute(rows)
    by_text = {}
    texts = dict(rows)
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_likeness_tells_edited_texts_from_others(spark):
    got = queries.QUERIES["op7_imatch"](spark, SF.replace("0.001", "0.01")).collect()
    edited, other = (statistics.mean(getattr(r, c) for r in got) for c in ("near_edited", "near_next"))
    assert edited > 2 * other
    print(edited, other)


def test_lexicon_is_bounded(spark, docs, monkeypatch):
    monkeypatch.setattr(im, "LEXICON_BYTES", 10)
    with pytest.raises(ValueError):
        im.lexicon(docs([(i, f"a{i % 8} b{i % 9}") for i in range(50)]))


def test_a_third_of_copies_and_near_copies_stay_comparable(spark, docs):
    """Their terms are above the band, while what the edit brings in has terms of the lexicon."""
    base = [f"hot{i}" for i in range(90)]
    rows = [(2 * i, " ".join(base)) for i in range(60)]  # copies
    rows += [(1000 + 2 * i, " ".join([f"own{i % 30}", *base[1:]])) for i in range(60)]  # differ by a word of the lexicon
    rows += [(2 * i + 1, " ".join(f"t{(i * 7 + k) % 60}x{k}" for k in range(90))) for i in range(240)]
    words = im.lexicon(docs(rows))
    assert not set(words) & {b.encode() for b in base} and b"own3" in words
    got = {r.doc_id: r for r in im.digest(im.compare(docs(rows))).collect()}
    hot, usual = ([r.near_edited for i, r in got.items() if i % 2 == odd] for odd in (0, 1))
    assert min(hot) > 0 and statistics.mean(hot) > 0.8 * statistics.mean(usual), (hot, usual)
    f = im.Fingerprinter(words)
    prints = [f(dict(rows)[i]) for i in (0, 1000, 1002)] + [f(" ".join([*base, "unseen"]))]
    assert all(im.likeness(a, b) > 0.7 for a in prints for b in prints)
    assert len({len(p) for p in prints}) == 1
    assert im.likeness(prints[0], f(dict(rows)[1])) == 0


def test_long_texts_in_parts(monkeypatch):
    f, text = im.Fingerprinter([b"w1"]), " ".join(f"w{i}" for i in range(1000))
    whole = f(text)
    monkeypatch.setattr(im, "TOGETHER", 7)
    monkeypatch.setattr(im, "REMEMBERED", 20)
    assert im.Fingerprinter([b"w1"])(text) == whole and im.likeness(f("w3 w3"), f("w4")) == 0 and im.likeness(f(""), f(" ")) == 1


def test_planning_does_not_grow_with_ranges(spark):
    """The plan is the same size for few and for many ranges."""
    frame = spark.range(5000).selectExpr("id as doc_id", "concat('w', id % 977, ' and w', id % 13) as text")
    before, sizes = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (8, 211):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            start = time.perf_counter()
            rows = im.with_next(frame)
            sizes.append(len(rows._jdf.queryExecution().optimizedPlan().toString()))
            assert time.perf_counter() - start < 60
            assert rows.filter("not halo").count() == 5000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sizes[1] < 1.2 * sizes[0]


def test_only_the_last_third_is_split_again(monkeypatch):
    """A text is split once and what the edit brings in once; words that the cut falls into are made whole."""
    f, seen, lower = im.Fingerprinter([b"ab", b"cd", b"e"]), [], im._lower
    texts = ["", " ", "ab", "abcdef", "ab cd e", "ab cd efé AB", "a b c d e f g h i", "\ud800ab cd \U0001f600x", "ab cd   ", " \n\tab cd\x1f e"]
    want = {t: f(t) for a in texts for b in texts for t in (a, a[:len(a) - len(a) // 3] + b[:len(a) // 3])}
    monkeypatch.setattr(im, "_lower", lambda t: seen.append(len(t)) or lower(t))
    for a in texts:
        for b in texts:
            seen.clear()
            own = f.prepare(a)
            text, edited = f.edited(own, b)
            assert own.fingerprint == want[a] and edited == want[text] and text == a[:len(a) - len(a) // 3] + b[:len(a) // 3]
            assert sum(seen) <= len(a) + len(a) // 3
