from collections import Counter

import corpus_pipeline
from gridmix.llm import common, mixing, piece_sampling, quality
from llm_data import DOCS, EDGES, SF
from test_secret_scan import brute as secrets_in
from test_simhash_dedup import brute as duplicates


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mix", "pieces"]


def test_run_against_brute_force(spark):
    """Every stage checked on its own input."""
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    step, out = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        step = common.materialize(stage(spark, step, sf), name)
        out[name] = step.collect()
        if name != "pieces":
            assert step.columns == docs.columns
    # quality: what the score says, which is what labels say
    score = {r.id: r.predicted for r in quality.score(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    kept = {r.doc_id for r in out["quality"]}
    assert kept == {i for i, p in score.items() if p}
    assert sum((i in kept) == bool(y) for i, y in marks.items()) / len(marks) > 0.95
    # near-duplicates: the smallest id of each component
    groups = duplicates([(r.doc_id, r.text) for r in out["quality"]])
    assert sorted(r.doc_id for r in out["near_duplicates"]) == sorted({g[2] for g in groups})
    # secrets: none left, other texts untouched
    before = {r.doc_id: r for r in out["near_duplicates"]}
    assert len(out["secrets"]) == len(before)
    for r in out["secrets"]:
        assert sum(secrets_in(r.text)[:3]) == 0 and r.n_chars == len(r.text)
        if not sum(secrets_in(before[r.doc_id].text)[:3]):
            assert r == before[r.doc_id]
        else:
            assert "[REDACTED]" in r.text
    # mix: copies as drawn, each the document itself
    drawn = {r.id: r.copies if r.size else 1 for r in mixing.mix(spark.createDataFrame(out["secrets"], docs.schema)).collect()}
    assert Counter(r.doc_id for r in out["mix"]) == Counter({i: n for i, n in drawn.items() if n})
    assert set(out["mix"]) <= set(out["secrets"])
    # pieces decode to the texts
    assert len(out["pieces"]) == len(out["mix"]) and all(r.decoded == r.text for r in out["pieces"])
    v = piece_sampling.vocabulary()
    for r in out["pieces"][:20]:
        assert list(piece_sampling.segment([str(r.doc_id)], [r.text], v)[0]) == r.pieces
    again = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(str, again)) == sorted(map(str, out["pieces"]))


def test_edges(spark, docs):
    for rows in (EDGES, []):
        step = docs(rows, "pieces_") if rows else spark.createDataFrame([], DOCS)
        columns = step.columns
        for name, stage in corpus_pipeline.STAGES:
            step = common.materialize(stage(spark, step, SF), name)
            if name != "pieces":
                assert step.columns == columns
        assert rows or step.count() == 0
