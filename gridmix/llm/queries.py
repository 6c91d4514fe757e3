"""The registered queries of the numbered operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmix.llm import (common, html_blocks, imatch, lm_score, mixing, phrase_mining, piece_sampling, quality,
                         secret_scan, simhash_dedup, token_alignment, topk_search, url_filter, warc)
from gridmix.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL twins.  Hashes (2, 3), span positions (1) and the trained or parsed results have none.
ORACLE: dict[str, str] = {"op4_topk_search": topk_search.ORACLE, "op5_warc": warc.ORACLE,
                          "op12_url_filter": url_filter.ORACLE, "op13_phrase_mining": phrase_mining.ORACLE}


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.prepare(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        return fn

    return register


@query("op1_secret_scan")
def op1(spark, sf_dir):
    """Secrets in every document, scanned through a new ledger."""
    ledger = work_dir(spark, "ledger")
    return secret_scan.digest(secret_scan.scan(common.table(spark, sf_dir, "documents"), ledger))


@query("op2_simhash_dedup")
def op2(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash_dedup.digest(simhash_dedup.near_duplicates(common.table(spark, sf_dir, "documents")))


@query("op3_mixing")
def op3(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.digest(mixing.mix(common.table(spark, sf_dir, "documents")))


@query("op4_topk_search")
def op4(spark, sf_dir):
    """The 5 best other vectors of each vector whose id is divisible by 50."""
    return topk_search.top_k(common.table(spark, sf_dir, "embeddings"))


@query("op5_warc")
def op5(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    return warc.digest(warc.round_trip(common.table(spark, sf_dir, "pages"), work_dir(spark, "archives")))


@query("op6_lm_score")
def op6(spark, sf_dir):
    """Base and interpolated scores of every document."""
    return lm_score.digest(lm_score.score(common.table(spark, sf_dir, "documents")))


@query("op7_imatch")
def op7(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return imatch.digest(imatch.compare(common.table(spark, sf_dir, "documents")))


@query("op8_piece_sampling")
def op8(spark, sf_dir):
    """A sampled segmentation of every document, decoded again."""
    return piece_sampling.digest(piece_sampling.round_trip(common.table(spark, sf_dir, "documents")))


@query("op9_html_extract")
def op9(spark, sf_dir):
    """Main text of every page."""
    return html_blocks.extract(common.table(spark, sf_dir, "pages"))


@query("op10_quality")
def op10(spark, sf_dir):
    """Quality score of every document."""
    return quality.digest(quality.score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")))


@query("op11_token_alignment")
def op11(spark, sf_dir):
    """Tokens of two tokenizers aligned in every document, with corpus-wide counts of linked ids."""
    return token_alignment.digest(token_alignment.align(common.table(spark, sf_dir, "documents")))


@query("op12_url_filter")
def op12(spark, sf_dir):
    """Verdict on every page's URL."""
    return url_filter.digest(common.table(spark, sf_dir, "pages"), url_filter.query_rules(spark))


@query("op13_phrase_mining")
def op13(spark, sf_dir):
    """The best phrases of every language."""
    return phrase_mining.digest(common.table(spark, sf_dir, "documents"))
