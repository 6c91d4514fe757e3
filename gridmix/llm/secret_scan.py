"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text.  The ledger (a Parquet table) says which
rules, in which version, have seen which blob and what they found.  An increment scans only pairs of blob and
rule version that the ledger lacks, one text per distinct blob, and joins the findings back to all paths.

Defined results: a null text is the empty text (a blob of its own digest, without findings); rows that repeat
an id or a text each get the findings of their text; a null path is kept as null; an empty table adds nothing
to the ledger; further columns of the input are ignored.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gridmix.llm import common


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; those whose group is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0
    either_case: bool = False

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self) -> "re.Pattern":
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))


BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         6, 2, True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),  # a run of 20 or more, prefix included
    Rule("hex", 1, r"[0-9a-f]{24,}"),  # runs are maximal, so shorter ones need not be matched first
)
#: What stands between the lines of a key: white space, marks of quoted or commented lines, escaped line ends.
_BETWEEN = r"""(?:[\s>#|"']|\\[nr])"""
#: A key's body without its END line: headers, lines of base64, a short last one, a checksum.
_BODY = (rf"(?:(?:{_BETWEEN}++[A-Za-z][A-Za-z-]{{0,32}}:\x20[^\r\n\\]*+)*+(?:{_BETWEEN}++[A-Za-z0-9+/=]{{16,}}+)++"
         rf"(?:{_BETWEEN}++[A-Za-z0-9+/]++={{0,2}}+(?=[\r\n\\\"']|\Z))?+(?:{_BETWEEN}++=[A-Za-z0-9+/]{{4}}(?![A-Za-z0-9+/]))?+)?+")
#: What the ledger adds to the base rules.
MORE = (
    # through the matching END line, if that comes before another BEGIN or END line, else to the end of the body
    Rule("pem", 2, r"-----BEGIN ([A-Z0-9 ]{0,32}PRIVATE KEY(?: BLOCK)?)-----"
         rf"(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1-----|{_BODY})"),
    Rule("github", 1, r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
KINDS = tuple(r.kind for r in RULES)

#: Increments that the versions of a table are scanned in.
INCREMENTS = 2
FINDINGS = "array<struct<rule:string,kind:string,start:int,end:int>>"
LEDGER = f"blob string, scanned array<string>, findings {FINDINGS}"
_ARROW_FINDINGS = pa.list_(pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int32()),
                                      ("end", pa.int32())]))


def versions(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, text, blob): null texts become empty ones."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(path).alias("path"), t.alias("text"), F.sha2(t, 256).alias("blob"))


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {r.id: (r, r.spans()) for r in rules}
        for batch in batches:
            found = []
            for text, todo in zip(batch.column("text").to_pylist(), batch.column("todo").to_pylist()):
                found.append([
                    {"rule": rule.id, "kind": rule.kind, "start": m.start(), "end": m.end()}
                    for rule, pattern in (ready[i] for i in todo)
                    for m in pattern.finditer(text)
                    if m.end(rule.group) - m.start(rule.group) >= rule.least])
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob").cast(pa.string()), batch.column("todo"), pa.array(found, _ARROW_FINDINGS)],
                names=["blob", "scanned", "findings"])

    return run


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger's rows (none before the first increment)."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, text, todo): one row for each distinct blob that some rule version has not seen.

    The text is picked by a partial aggregate, so a text with many copies leaves each map task once.
    """
    every = F.array(*[F.lit(r.id) for r in rules])
    blobs = paths.groupBy("blob").agg(F.first("text").alias("text"))
    seen = (read_ledger(paths.sparkSession, ledger).select("blob", F.explode("scanned").alias("rule"))
            .groupBy("blob").agg(F.collect_set("rule").alias("seen")))  # one entry per rule version
    todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
    # the ledger grows with the documents: never broadcast; its part of a partition is a small table beside the texts
    return blobs.join(seen.hint("shuffle_hash"), "blob", "left").select("blob", "text", todo.alias("todo")).filter(F.size("todo") > 0)


def scan_increment(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks and append it.  A repeated increment adds nothing."""
    unseen(paths, ledger, rules).mapInArrow(_scan(rules), LEDGER).write.mode("append").parquet(ledger)


def scan_increments(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, n: int = INCREMENTS) -> None:
    """The versions in n increments by their paths, so that each but the first meets what earlier ones have seen."""
    part = F.pmod(F.xxhash64("path"), F.lit(n))
    for i in range(n):
        scan_increment(paths.filter(part == i), ledger, rules)


def findings(spark, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found): blobs with spans of these rule versions, by start, then by the rules' order."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.id), F.lit(i))])
    rows = (read_ledger(spark, ledger).select("blob", F.explode("findings").alias("f"))
            .filter(F.col("f.rule").isin([r.id for r in rules])))
    # collect_set: spans of one text; a row written twice by a repeated increment counts once
    spans = F.collect_set(F.struct(F.col("f.start").alias("start"), order[F.col("f.rule")].alias("order"),
                                   F.col("f.end").alias("end"), F.col("f.kind").alias("kind")))
    return rows.groupBy("blob").agg(F.array_sort(spans).alias("found"))


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(path, blob, found): run the increments, then give every path the findings of its blob (null if none)."""
    paths = versions(docs, path, text)
    scan_increments(paths, ledger, rules)
    found = common.materialize(findings(docs.sparkSession, ledger, rules), "findings")
    return paths.select("path", "blob").join(found, "blob", "left")


def _joined(found) -> "F.Column":
    return F.coalesce(F.array_join(F.transform(
        found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","),
        F.lit(""))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of each path's spans."""
    base = F.filter("found", lambda s: s["kind"].isin([r.kind for r in BASE]))

    def n(kind):
        return F.coalesce(F.size(F.filter("found", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")

    count = {k: F.when(F.col("found").isNull(), F.lit(0).cast("long")).otherwise(n(k)) for k in ("assign", "access", "hex")}
    return scanned.select(
        F.col("path").alias("doc_id"), *[c.alias(f"n_{k}") for k, c in count.items()],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def _masked(text, spans):
    """The text with [REDACTED] for every span; of spans that overlap, one mark for all.  Spans are sorted."""
    def step(done, s):
        new = s["start"] >= done["at"]
        between = F.when(new, F.concat(F.substring(text, done["at"] + 1, s["start"] - done["at"]),
                                       F.lit("[REDACTED]"))).otherwise(F.lit(""))
        return F.struct(F.concat(done["out"], between).alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(spans, start, step,
                       lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def redact(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every span of a secret replaced by [REDACTED]; others stay as they are.

    ``n_chars`` is set anew where the text changed.
    """
    scan_increments(versions(docs), ledger, rules)
    found = common.materialize(findings(docs.sparkSession, ledger, rules), "findings")
    blob = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    found = found.select(F.col("blob").alias("llm_blob_"), F.col("found").alias("llm_found_"))
    # findings grow with the documents: never broadcast; a text with very many copies is dealt out by their ids
    joined = common.dealt_join(docs.withColumn("llm_blob_", blob), found, "llm_blob_", "doc_id", "left")
    hit = F.col("llm_found_").isNotNull()
    masked = joined.withColumn("text", F.when(hit, _masked(F.col("text"), F.col("llm_found_"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(hit, length).otherwise(F.col("n_chars")))
    return masked.select(*[f"`{c}`" for c in docs.columns])
