"""Mixing sources to target weights by Pareto order sampling.

Sources share the corpus size by weight, up to ``MOST`` times their own size; what a source can't take is
reshared among the others by weight.  Inside a source a document is expected in ``e`` copies, in proportion to
its affinity (by default size ** -TEMPER, so that long documents are repeated less), ``MOST`` at the most.  The whole copies
are certain.  The rest is drawn by Pareto order sampling: documents are ranked by random odds divided by the odds
of their fractional copy, u / (1 - u) / (p / (1 - p)), and the first ones get a copy more, as many as bring the source nearest
to its target.  The size of the sample is fixed in words, so a source misses its target by half a document at
most.  Random numbers are a hash of the row, so reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, last in order; documents of size
0 take nothing; equal rows are drawn one by one; a null id takes part, its random number comes from its text; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm import common

#: Weights of the sources, repeating in their order.
WEIGHTS = (1, 2, 3)
#: Times its size that a source or a document can be taken.
MOST = 3
TEMPER = 0.25
SEED = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def uniform(*columns, seed: int = SEED) -> Column:
    """A reproducible number strictly between 0 and 1 for each row."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (h.cast("double") + 0.5) * F.lit(2.0 ** -53)


def sizes(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, nosource, src, size, u): narrow rows that stand for the documents (``id`` names the row)."""
    return docs.select(
        F.col(id).alias("id"), F.col("source").isNull().alias("nosource"),
        F.coalesce(F.col("source"), F.lit("")).alias("src"), word_count(F.col("text")).alias("size"),
        uniform(F.col("doc_id").cast("string"), F.col("source"), F.col("text")).alias("u"))


def targets(rows: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """(nosource, src, source_size, target): one row per source."""
    sources = rows.groupBy("nosource", "src").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("one", F.lit(1).cast("long")).withColumn("all_", F.lit(0))
    ranked = common.prefix_sums(sources, ["all_"], [F.col("nosource"), F.col("src")], "one", "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = common.materialize(ranked.select("nosource", "src", "source_size", weight.alias("weight")), "sources")
    limit = F.col("source_size") * F.lit(float(MOST))
    share, full = 0.0, -1
    while True:  # the driver sees four numbers a round; sources only ever become full, so this ends
        at_limit = limit < F.lit(share) * F.col("weight")
        total, n, taken, open_ = ranked.agg(
            F.sum("source_size"), F.count(F.when(at_limit, 1)), F.sum(F.when(at_limit, limit)),
            F.sum(F.when(~at_limit, F.col("weight")))).first()
        if n == full or not open_:
            break
        share, full = ((total or 0) - (taken or 0.0)) / open_, n
    return ranked.select("nosource", "src", "source_size",
                         F.least(limit, F.lit(share) * F.col("weight")).alias("target"))


def expected(rows: DataFrame, sources: DataFrame, affinity: Column) -> DataFrame:
    """Adds the source's figures and ``copies``, the expected copies of a document of any size.

    Documents at their limit hand on to others of their source, in rounds.  Rates never fall, so documents only ever reach
    their limit, and the rounds end when none does.
    """
    rows = rows.join(sources, ["nosource", "src"]).withColumn("affinity", affinity)
    rate, done = None, False
    while not done:
        known = rows if rate is None else rows.join(rate, ["nosource", "src"])
        at_limit = F.lit(False) if rate is None else F.col("rate") * F.col("affinity") >= MOST
        room = F.first("target") - F.coalesce(F.sum(F.when(at_limit, F.col("size") * float(MOST))), F.lit(0.0))
        open_ = F.sum(F.when(~at_limit, F.col("affinity") * F.col("size")))
        share = F.coalesce(F.greatest(room, F.lit(0.0)) / F.nullif(open_, F.lit(0.0)), F.lit(float("inf")))
        after = known.groupBy("nosource", "src").agg(
            (share if rate is None else F.greatest(share, F.first("rate"))).alias("rate"),
            F.count(F.when(at_limit, 1)).alias("full"))
        after = common.materialize(after, "rates")
        done = rate is not None and after.join(
            rate.select("nosource", "src", F.col("full").alias("before")), ["nosource", "src"]
        ).filter("full <> before").limit(1).count() == 0
        rate = after
    return rows.join(rate.select("nosource", "src", "rate"), ["nosource", "src"]).withColumn(
        "copies", F.least(F.lit(float(MOST)), F.col("rate") * F.col("affinity")))


def sample(rows: DataFrame, weights: tuple = WEIGHTS, affinity: Column | None = None) -> DataFrame:
    """(id, size, source_size, target, copies): the copies that the mix takes of every document."""
    rows = common.materialize(rows, "sizes")
    if affinity is None:
        affinity = F.pow(F.greatest(F.col("size"), F.lit(1)).cast("double"), F.lit(-TEMPER))
    rows = expected(rows, common.materialize(targets(rows, weights), "targets"), affinity)
    sure = F.floor(F.col("copies") + F.lit(1e-9))
    part = F.greatest(F.lit(0.0), F.col("copies") - sure)
    rank = F.when(part > 1e-9, F.col("u") / (1 - F.col("u")) * (1 - part) / part)
    rows = common.materialize(
        rows.select("id", "nosource", "src", "size", "source_size", "target", sure.alias("sure"),
                    rank.alias("rank"), "u"), "ranked")
    # what whole copies leave of the target, one row per source
    left = rows.groupBy("nosource", "src").agg(
        (F.first("target") - F.sum(F.col("sure") * F.col("size")).cast("double")).alias("left"))
    order = [F.col("rank").asc_nulls_last(), F.col("u"), F.col("id"), F.col("size")]
    summed = common.prefix_sums(rows, ["nosource", "src"], order, "size", "before").join(left, ["nosource", "src"])
    # middles of documents grow along the order, so these are its first ones, and end nearest to the target
    more = F.col("rank").isNotNull() & (F.col("before") + F.col("size") / 2 <= F.col("left"))
    return summed.select("id", "size", "source_size", "target",
                         (F.col("sure") + more.cast("long")).cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, affinity: Column | None = None) -> DataFrame:
    return sample(sizes(docs), weights, affinity)


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """The documents themselves, each as often as the mix takes it.  Documents without words stay once."""
    columns = [f"`{c}`" for c in docs.columns]
    keyed = common.numbered(docs.withColumn("llm_key_", common.row_key(F.col("doc_id"), F.col("text"))), "llm_key_", "llm_nth_")
    named = keyed.withColumn("llm_id_", F.concat_ws("#", "llm_nth_", "llm_key_"))
    copies = sample(sizes(named, "llm_id_"), weights)
    copies = copies.select(F.col("id").alias("llm_id_"), F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies"))
                           .cast("int").alias("llm_copies_")).filter("llm_copies_ > 0")
    copies = common.materialize(copies, "copies")
    taken = named.join(copies.hint("merge"), "llm_id_")  # copies grow with the documents: never broadcast
    return taken.withColumn("llm_copy_", F.explode(F.sequence(F.lit(1), F.col("llm_copies_")))).select(*columns)
