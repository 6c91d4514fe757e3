"""URL filters by hashed host-suffix and path-prefix expressions.

A rule is a host and a path with a verdict.  It fits its host and all subdomains where the URL's path starts with the rule's.
Every distinct (host, path) of the table is expanded into expressions: a suffix of the host at a label with a prefix of
the path at a slash (or none).  Expressions meet rules in an equi-join on the first 32 bits of their SHA-256.  What
meets is confirmed by the full digest, and by the rest of the rule's path where that doesn't end in a slash.  The longest rule that is left
gives the verdict; rows that none fits get the default one.

No rule has more labels or slashes than the deepest one, so URLs are expanded to that depth: longer expressions
couldn't meet any.  Equal URLs are judged once, so one that a third of all rows share is one row of the join; its
verdict is spread over ``SALTS`` tasks on the way back.  Rules are broadcast where they are counted to be at most ``BROADCAST_RULES``
(their texts together at most ``BROADCAST_BYTES``); longer lists meet salted expressions in a sort-merge join.  Everything
is built-in functions.

Defined results: host and path of a null URL, or one without ``://``, are empty, and no rule fits them; an empty path doesn't
start with ``/``; only A-Z are lower-cased; ports and users count as part of the host; among fitting rules of one length that with the longer
host wins, then ``block``; rules with a null or empty host fit nothing, a null path is empty; rows that repeat are kept; an empty table gives an empty
result; further columns are kept by ``judge`` under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm import common

#: (verdict, host, path).  Fixed values of the query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DEFAULT = "allow"
BROADCAST_RULES, BROADCAST_BYTES = 20_000, 4 << 20
#: Hexadecimal digits of the digest that the join looks at.
SHORT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _short(digest: Column) -> Column:
    """The first bits of a hexadecimal digest as a long."""
    return F.conv(F.substring(digest, 1, SHORT), 16, 10).cast("long")


def compiled(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) with the expression that they are found by: the host and the path to its last slash."""
    rules = rules.select("verdict", F.translate("host", _UPPER, _LOWER).alias("rule_host"),
                         F.coalesce("path", F.lit("")).alias("rule_path")).filter("rule_host <> ''").distinct()
    folder = F.regexp_extract("rule_path", r"(?s)^(.*/)?", 1)
    digest = F.sha2(F.concat("rule_host", folder), 256)
    return rules.select("verdict", "rule_host", "rule_path", digest.alias("rule_digest"), _short(digest).alias("short"),
                        (_count(F.col("rule_host"), ".") + 1).alias("labels"), _count(F.col("rule_path"), "/").alias("slashes"))


def expressions(urls: DataFrame, labels: int, slashes: int) -> DataFrame:
    """(host, path, short, digest): every expression of ``urls`` (host, path) of at most so many labels and slashes."""
    of_host = F.explode(F.sequence(F.lit(1), F.least(_count(F.col("host"), ".") + 1, F.lit(labels))))
    urls = urls.filter("host <> ''").withColumn("n_labels", of_host)
    of_path = F.explode(F.sequence(F.lit(0), F.least(_count(F.col("path"), "/"), F.lit(slashes))))
    urls = urls.withColumn("n_slashes", of_path)
    suffix = F.expr("substring_index(host, '.', -n_labels)")
    prefix = F.when(F.col("n_slashes") == 0, "").otherwise(F.expr("concat(substring_index(path, '/', n_slashes), '/')"))
    digest = F.sha2(F.concat(suffix, prefix), 256)
    return urls.select("host", "path", digest.alias("digest")).withColumn("short", _short(F.col("digest")))


def _bounded(rules: DataFrame) -> tuple[bool, int, int]:
    """Whether the rules may be broadcast, and the most labels and slashes of one: one row to the driver."""
    n, size, labels, slashes = rules.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("rule_host") + F.octet_length("rule_path") + 100), F.lit(0)),
        F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("slashes"), F.lit(0))).first()
    return n <= BROADCAST_RULES and size <= BROADCAST_BYTES, labels, slashes


def verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct ``urls`` (host, path) that a rule fits."""
    rules = common.materialize(compiled(rules), "rules")
    small, labels, slashes = _bounded(rules)
    rules = rules.drop("labels", "slashes")
    found = expressions(urls, labels, slashes)
    if small:
        met = found.join(F.broadcast(rules), "short")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(common.SALTS - 1)))
        salt = F.pmod(F.xxhash64("host", "path"), F.lit(common.SALTS)).cast("int")
        met = found.withColumn("salt", salt).join(rules.withColumn("salt", salts).hint("merge"), ["short", "salt"])
    fits = met.filter((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")))
    rank = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"), F.length("rule_host").alias("host"),
                    (F.col("verdict") == "block").alias("block"))
    # rank first: rules of equal rank for one URL are the same text
    best = F.max(F.struct(rank.alias("rank"), F.concat("rule_host", "rule_path").alias("rule"), "verdict"))
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(table: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """The table's rows with a struct ``judged`` of (host, path, rule, verdict) behind its columns.

    Their names may be any: they travel in a struct of their own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias("row")
    rows = table.select(row, host(F.col(f"`{url}`")).alias("host"), path(F.col(f"`{url}`")).alias("path"))
    found = verdicts(rows.select("host", "path").distinct(), rules)
    spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(common.SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(common.SALTS)).cast("int"))
    out = rows.join(spread.hint("merge"), ["host", "path", "salt"], "left")
    judged = F.struct("host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    return out.select("row.*", judged.alias("judged"))


def query_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "verdict string, host string, path string")


def digest(pages: DataFrame, rules: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url"), rules).select("page_id", "judged.*")


_RULES_SQL = ", ".join(str(r) for r in RULES)
ORACLE = rf"""
with rules(verdict, rule_host, rule_path) as (values {_RULES_SQL}),
cut as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
    from cut),
fits as (
    select host, path, max({{'n': length(rule_host || rule_path), 'h': length(rule_host), 'b': verdict = 'block',
                            'rule': rule_host || rule_path, 'verdict': verdict}}) as best
    from (select distinct host, path from parts) join rules
      on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by host, path)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, '{DEFAULT}') as verdict
from parts left join fits using (host, path)
"""
