import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm_data import DOCS, EDGES, SF
from gridmix.llm import mixing, queries


def water(sizes):
    """Targets by hand: {source: size} -> {source: target}."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        room = total - sum(3 * sizes[s] for s in full)
        target = {s: 3.0 * sizes[s] if s in full else room * weight[s] / sum(weight[r] for r in rest) for s in names}
        above = {s for s in rest if target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def check(rows, got):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += size(r[1])
    want = water(sizes)
    assert sorted((str(r[0]), size(r[1]), sizes[r[2]]) for r in rows) == sorted(
        (str(g.doc_id), g.size, g.source_size) for g in got)
    source = {(r[0], size(r[1]), sizes[r[2]]): r[2] for r in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for g in got:
        s = source[g.doc_id, g.size, g.source_size]
        assert abs(g.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= g.taken <= 3 * g.size and g.taken % max(1, g.size) == 0
        taken[s] += g.taken
        largest[s] = max(largest[s], g.size)
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, (s, taken[s], want[s])


def test_edges(spark, docs):
    rows = [(*r[:2], ["b", "a", None, "B"][i % 4]) for i, r in enumerate(EDGES)]
    frame = docs(rows, "target")
    check(rows, mixing.digest(mixing.mix(frame)).collect())


def test_source_of_one_word_and_of_none(spark, docs):
    rows = [(1, "x", "a"), (2, "", "b"), (3, " ".join("y" * 500), "c"), (4, " ".join("z" * 30), "c"), (5, None, None)]
    check(rows, mixing.digest(mixing.mix(docs(rows))).collect())


def test_empty_and_wordless(spark, docs):
    assert mixing.digest(mixing.mix(spark.createDataFrame([], DOCS))).collect() == []
    rows = [(1, "", "a"), (2, None, "b")]
    got = mixing.digest(mixing.mix(docs(rows))).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_query(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op3_mixing"](spark, SF).collect()
    check(rows, got)
    again = queries.QUERIES["op3_mixing"](spark, SF).repartition(3).collect()
    assert sorted(got) == sorted(again)


def test_pareto_ranks_by_odds(spark):
    """Rows are taken in the order of u / (1 - u) / (p / (1 - p)), at inclusion rates near p."""
    n = 4000
    rows = spark.range(n).select(
        F.col("id"), F.lit(False).alias("nosource"), F.lit("a").alias("src"), F.lit(1).cast("long").alias("size"),
        mixing.uniform(F.col("id")).alias("u"))
    # one source takes all words: affinity 1 : 3 gives 0.5 and 1.5 copies
    got = mixing.sample(rows, (1,), F.when(F.col("id") % 2 == 0, 1.0).otherwise(3.0)).collect()
    even, odd = (sum(r.copies for r in got if r.id % 2 == b) / (n / 2) for b in (0, 1))
    assert abs(even - 0.5) < 0.03 and abs(odd - 1.5) < 0.03 and sum(r.copies for r in got) == n
    assert {r.copies for r in got if r.id % 2} == {1, 2} and {r.copies for r in got if r.id % 2 == 0} == {0, 1}


def test_documents_are_repeated(spark, docs):
    rows = [(*r[:2], ["b", "a", None][i % 3]) for i, r in enumerate(EDGES)]
    frame = docs(rows, "copies_")
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    want = sum((r.taken // r.size if r.size else 1) for r in mixing.digest(mixing.mix(frame)).collect())
    assert out.count() > 0 and abs(out.count() - want) <= 3


def test_rounds_go_on_until_no_document_reaches_its_limit(spark, docs):
    """Affinities that fall by 100 let one document reach its limit a round.  19 do, at 30 words each; the next one takes
    99 of 100 parts of the 30 words that are left."""
    rows = docs([(i, " ".join(["w"] * 10)) for i in range(60)])
    sized = mixing.sizes(rows)
    out = mixing.expected(sized, mixing.targets(sized), F.pow(F.lit(100.0), -F.col("id"))).collect()
    assert sum(r.copies * r["size"] for r in out) == pytest.approx(600)
    assert sorted(r.id for r in out if r.copies == 3) == list(range(19))
