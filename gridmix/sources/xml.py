"""Generation documents (XML): read, decode, flatten, triage — all with Spark's XML support.

Document shape (default or prefixed namespace)::

    <GL_MarketDocument>
      <TimeSeries>
        <MktPSRType><psrType>B16</psrType></MktPSRType>
        <Period>
          <timeInterval><start>2025-03-01T00:00Z</start><end>…</end></timeInterval>
          <resolution>PT15M</resolution>
          <Point><position>1</position><quantity>123.5</quantity></Point> …

A point's time is ``start + step * (position - 1)``; actual-generation documents take the step
from ``resolution`` (15/30/60 min, missing -> 60), day-ahead forecast documents always step one
hour.  A period without start and a point without (castable) position or quantity are dropped.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix import functions as gf
from gridmix import session

# Fixed values — document root elements, namespace and the "no data" acknowledgement reason.
GENERATION_ROOT = "GL_MarketDocument"
ACK_ROOT = "Acknowledgement_MarketDocument"
GENERATION_NS = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"

SERIES_DDL = ("MktPSRType struct<psrType: string>, "
              "Period array<struct<timeInterval: struct<start: string, `end`: string>, resolution: string, "
              "Point: array<struct<position: string, quantity: string>>>>")
DOCUMENT_DDL = f"TimeSeries array<struct<{SERIES_DDL}>>"
XML_OPTIONS = {"ignoreNamespace": "true"}

GENERATION_COLUMNS = ["timestamp", "country", "energy_source", "psr_type", "actual_MW", "forecast_MW", "domain"]


# --- decode ------------------------------------------------------------------------------------

CORRUPT = "_corrupt"


def _parsed(docs: DataFrame, xml_col: str) -> DataFrame:
    keep = [F.col(c) for c in docs.columns if c != xml_col]
    options = {**XML_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return docs.select(*keep, F.col(xml_col).alias("_xml"),
                       F.from_xml(F.col(xml_col), f"{DOCUMENT_DDL}, {CORRUPT} string", options).alias("_doc"))


def _is_corrupt():
    return F.col("_xml").isNull() | F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull()


def decode_documents(docs: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per TimeSeries: ``series`` struct plus the document's other columns.  Documents that don't
    parse have none; ``rejects`` lists them."""
    keep = [c for c in docs.columns if c != xml_col]
    return _parsed(docs, xml_col).where(~_is_corrupt()).select(*keep, F.explode("_doc.TimeSeries").alias("series"))


def _bad_starts(series: Column) -> Column:
    """Periods of a document whose start is missing or no time."""
    starts = F.flatten(F.transform(F.coalesce(series, F.array()), lambda s: F.transform(
        F.coalesce(s["Period"], F.array()), lambda p: p["timeInterval"]["start"])))
    return F.size(F.filter(starts, lambda t: gf.parse_xml_time(t).isNull()))


def read_through(docs: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Documents read once, for all that is asked of them: the other columns, triage ``status``, ``reason`` (why the document
    or a part of it is left out, else null), ``n`` (documents or periods left out), and the decoded ``TimeSeries``
    (null for documents that are left out)."""
    keep = [F.col(c) for c in docs.columns if c != xml_col]
    parsed = _parsed(triage(docs, xml_col, keep_document=True), xml_col)
    bad = _bad_starts(F.col("_doc.TimeSeries"))
    reason = (F.when(F.col("status") != "ok", F.concat_ws(":", "status", "reason_code"))
              .when(_is_corrupt(), "corrupt").when(bad > 0, "bad_start"))
    whole = F.col("reason").isNull() | (F.col("reason") == "bad_start")
    return (parsed.select(*keep, "status", reason.alias("reason"), bad.cast("long").alias("bad"), "_doc.TimeSeries")
            .select(*keep, "status", "reason", F.when(F.col("reason") == "bad_start", F.col("bad"))
                    .when(F.col("reason").isNotNull(), F.lit(1)).otherwise(0).cast("long").alias("n"),
                    F.when(whole, F.col("TimeSeries")).alias("TimeSeries")))


def rejects(docs: DataFrame, xml_col: str = "xml") -> DataFrame:
    """What decoding leaves out, with a reason and a count: documents that don't parse (``corrupt``), and
    series periods whose start is missing or no time (``bad_start``), one row per document and reason."""
    keep = [c for c in docs.columns if c != xml_col]
    parsed = _parsed(docs, xml_col)
    bad = _bad_starts(F.col("_doc.TimeSeries"))
    return parsed.select(
        *keep, F.when(_is_corrupt(), "corrupt").when(bad > 0, "bad_start").alias("reason"),
        F.when(_is_corrupt(), F.lit(1)).otherwise(bad).cast("long").alias("n")).where(F.col("reason").isNotNull())


#: Days of a range whose folders are named one by one; folders of longer ranges are found by listing all.
NAMED_DAYS = 100
#: Folder of a tree for documents that share files.  Scans of the tree itself pass over names that begin with an underscore.
PACKED = "_packed"
PACKED_DDL = "country string, date date, domain string, xml string, month date"
PACKED_GROUP_BYTES = 32 << 20
DOCUMENT_SLICE = ["country", "date", "domain"]


def read_documents(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """Whole documents of a bronze tree: (xml, country, date, domain, path).  They are files of their own in
    ``root/country=../date=../domain=..``, or packed (``pack_documents``).  Where a slice (country, date, domain) has
    files of its own, they replace its packed documents: a corrected document is put there as it is fetched."""
    packed = _read_packed(spark, root, start, end)
    if packed is None:
        return _read_files(spark, root, start, end)
    if not session.matches(spark, f"{root}/country=*"):
        return packed
    from gridmix.sinks.versions import matching

    own = _read_files(spark, root, start, end)
    return own.unionByName(matching(packed, own.select(*DOCUMENT_SLICE).distinct(), DOCUMENT_SLICE, "left_anti"))


def _read_packed(spark: SparkSession, root: str, start, end) -> DataFrame | None:
    """Packed documents of a range, None where a tree has none packed.  Other months' folders aren't read, of a month's files only
    row groups and pages that have the range's days.  A path is the file's with the document's row in it."""
    if not session.exists(spark, f"{root}/{PACKED}"):
        return None
    rows = spark.read.schema(PACKED_DDL).parquet(f"{root}/{PACKED}")
    for bound, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None:
            day = bound if isinstance(bound, Column) else F.lit(str(bound)[:10]).cast("date")
            rows = rows.where(keep(F.col("date"), day) & keep(F.col("month"), F.trunc(day, "month")))
    path = F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    return rows.select("xml", *DOCUMENT_SLICE, path.alias("path"))


def _read_files(spark: SparkSession, root: str, start, end) -> DataFrame:
    """Documents that are files of their own.  Filters on the folder columns prune the files that are read.  Of a range of few days
    (dates or their text, inclusive) other days' folders aren't listed either."""
    schema = "value string, country string, date date, domain string"
    paths = _folders(spark, root, start, end)
    if paths:
        raw = spark.read.option("wholetext", "true").option("basePath", root).schema(schema).text(paths)
    else:
        raw = spark.read.option("wholetext", "true").schema(schema).text(root)
        if paths is not None:
            raw = raw.limit(0)
    return raw.select(F.col("value").alias("xml"), "country", "date", "domain", F.col("_metadata.file_path").alias("path"))


def _folders(spark: SparkSession, root: str, start, end) -> list[str] | None:
    """Folders of the days in a range, None where it is open, no dates or long."""
    if start is None or end is None or isinstance(start, Column) or isinstance(end, Column):
        return None
    first, last = (dt.date.fromisoformat(str(d)[:10]) for d in (start, end))
    n = (last - first).days + 1
    if n > NAMED_DAYS:
        return None
    days = ",".join((first + dt.timedelta(i)).isoformat() for i in range(n))
    return session.matches(spark, f"{root}/country=*/date={{{days}}}") if n > 0 else []


def document_days(spark: SparkSession, root: str, country: str = "*", domain: str | None = None) -> tuple:
    """The first and the last day that a tree has documents for, (None, None) where there is none: from the folders' names, and
    from the days of packed documents, of which nothing else is read."""
    days = [re.search(r"date=([0-9-]+)", path).group(1) for folder in session.matches(spark, f"{root}/country={country}")
            for path in session.first_and_last(spark, f"{folder}/date=[0-9]*" + (f"/domain={domain}" if domain else ""))]
    days = [dt.date.fromisoformat(d) for d in days]
    packed = _read_packed(spark, root, None, None)
    if packed is not None:
        packed = packed if country == "*" else packed.where(F.col("country") == country)
        packed = packed if domain is None else packed.where(F.col("domain") == domain)
        days += [d for d in packed.agg(F.min("date"), F.max("date")).first() if d is not None]
    return (min(days), max(days)) if days else (None, None)


def land_documents(docs: DataFrame, root: str, domain: str) -> None:
    """Write documents (country, date, xml) as files of the tree that ``read_documents`` reads, one document a file."""
    (docs.select("country", "date", F.lit(domain).alias("domain"), F.col("xml").alias("value"))
     .write.mode("append").option("maxRecordsPerFile", 1).partitionBy("country", "date", "domain").text(root))


def pack_documents(docs: DataFrame, root: str) -> None:
    """Add documents (country, date, domain, xml) to the packed ones of the tree that ``read_documents`` reads: Parquet files in a
    folder for each month, in order of the days, so files grow with months and bytes, not with documents.

    A row group ends by its bytes, looked at after every document: neither a writer nor a reader, which takes up to 4096
    rows of a group at once, holds many large documents."""
    (docs.select(*DOCUMENT_SLICE, "xml", F.trunc("date", "month").alias("month")).hint("rebalance", "month")
     .sortWithinPartitions("month", "date", "country", "domain").write.mode("append")
     .option("parquet.block.size", PACKED_GROUP_BYTES).option("parquet.page.size.row.check.min", 1)
     .partitionBy("month").parquet(f"{root}/{PACKED}"))


def read_series_files(spark: SparkSession, root: str) -> DataFrame:
    """Scan a bronze tree of XML files (row tag TimeSeries, any depth) with an explicit schema;
    the file path is kept for path-derived columns."""
    raw = (spark.read.format("xml").option("rowTag", "TimeSeries").option("ignoreNamespace", "true")
           .option("recursiveFileLookup", "true").schema(SERIES_DDL).load(root))
    return raw.select(F.struct("MktPSRType", "Period").alias("series"), F.col("_metadata.file_path").alias("path"))


def scan_series_files(spark: SparkSession, root: str) -> DataFrame:
    """The row-tag scan with nothing lost silently: (series, corrupt, path), where an element that doesn't parse has a null
    series and its text in ``corrupt``.  Elements that a file's end cuts off can't be rows; ``file_rejects`` counts them."""
    raw = (spark.read.format("xml").option("rowTag", "TimeSeries").option("ignoreNamespace", "true")
           .option("recursiveFileLookup", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .schema(f"{SERIES_DDL}, {CORRUPT} string").load(root))
    whole = F.col(CORRUPT).isNull()
    return raw.select(F.when(whole, F.struct("MktPSRType", "Period")).alias("series"), F.col(CORRUPT).alias("corrupt"),
                      F.col("_metadata.file_path").alias("path"))


def file_tags(spark: SparkSession, root: str) -> DataFrame:
    """(path, started, closed): TimeSeries elements that begin in each file, and whether its document ends.  The files are read as
    text records between ``<`` signs, so that large files are split among tasks and no document is held whole."""
    text = spark.read.option("lineSep", "<").option("recursiveFileLookup", "true").text(root)
    prefix = r"([A-Za-z_][\w.-]*:)?"
    return text.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count_if(F.col("value").rlike(rf"^{prefix}TimeSeries[\s>/]")).alias("started"),
        (F.count_if(F.col("value").rlike(rf"^/{prefix}{GENERATION_ROOT}\s*>")) > 0).alias("closed"))


def file_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(path, reason, n) of a tree of generation files: what the row-tag scan doesn't bring, counted from its rows and from
    the elements that begin in each file.

    ``cut``: the document has no end; n elements aren't there as a whole (0 where it ends between two).  ``corrupt``: elements that
    don't parse, and those that the scan gives up with them.  ``bad_start``: periods whose start is missing or no time."""
    scanned = scan_series_files(spark, root)
    bad = _bad_starts(F.array("series"))
    rows = scanned.groupBy("path").agg(F.count(F.lit(1)).alias("read"), F.count("corrupt").alias("corrupt"),
                                       F.coalesce(F.sum(F.when(F.col("series").isNotNull(), bad)), F.lit(0)).alias("bad"))
    files = file_tags(spark, root).join(rows, "path", "left").na.fill(0, ["read", "corrupt", "bad"])
    lost = F.col("started") - (F.col("read") - F.col("corrupt"))
    reasons = F.array(
        F.struct(F.lit("cut").alias("reason"), lost.alias("n"), (~F.col("closed")).alias("is")),
        F.struct(F.lit("corrupt").alias("reason"), lost.alias("n"), (F.col("closed") & (lost > 0)).alias("is")),
        F.struct(F.lit("bad_start").alias("reason"), F.col("bad").alias("n"), (F.col("bad") > 0).alias("is")))
    return files.select("path", F.inline(reasons)).where("is").drop("is")


def flatten_series(series: DataFrame, kind: str = "generation", country: Column | str = "country") -> DataFrame:
    """TimeSeries rows -> silver generation rows (``timestamp`` as TIMESTAMP).

    ``kind='generation'``: quantity -> actual_MW, step from the resolution;
    ``kind='forecast'``: quantity -> forecast_MW, step fixed at 60 minutes.
    """
    ctry = gf.col_of(country)
    psr = F.coalesce(F.col("series.MktPSRType.psrType"), F.lit("unknown"))
    periods = series.select(ctry.alias("country"), psr.alias("psr_type"), F.explode("series.Period").alias("p"))
    step = gf.resolution_minutes(F.col("p.resolution")) if kind == "generation" else F.lit(60)
    points = periods.select(
        "country", "psr_type", gf.parse_xml_time(F.col("p.timeInterval.start")).alias("start"),
        step.alias("step"), F.explode("p.Point").alias("pt"),
    ).where(F.col("start").isNotNull())
    pos = F.col("pt.position").try_cast("int")
    qty = F.col("pt.quantity").try_cast("double")
    rows = points.where(pos.isNotNull() & qty.isNotNull())
    actual = qty if kind == "generation" else F.lit(None).cast("double")
    forecast = F.lit(None).cast("double") if kind == "generation" else qty
    return rows.select(
        gf.point_time(F.col("start"), F.col("step"), pos).alias("timestamp"), "country",
        gf.psr_name("psr_type").alias("energy_source"), "psr_type",
        actual.alias("actual_MW"), forecast.alias("forecast_MW"), F.lit(kind).alias("domain"),
    )


def to_silver_generation(rows: DataFrame) -> DataFrame:
    """TIMESTAMP -> epoch nanoseconds, the silver storage format."""
    return rows.select(
        (F.unix_micros(F.col("timestamp")) * F.lit(1000)).alias("timestamp"), "country", "energy_source",
        "psr_type", F.col("actual_MW").cast("double"), F.col("forecast_MW").cast("double"), "domain",
    )


# --- triage (A13) ------------------------------------------------------------------------------

def triage(docs: DataFrame, xml_col: str = "xml", keep_document: bool = False) -> DataFrame:
    """Classify each fetched document: ``ok`` (generation document), ``ack`` (acknowledgement
    with a reason) or ``other``, with the reason code and text when present."""
    x = F.col(xml_col)
    is_gen = x.contains("<" + GENERATION_ROOT) | x.rlike("<[A-Za-z0-9_]+:" + GENERATION_ROOT)
    is_ack = x.contains("<" + ACK_ROOT) | x.rlike("<[A-Za-z0-9_]+:" + ACK_ROOT)
    code = F.xpath_string(x, F.lit("//*[local-name()='Reason']/*[local-name()='code']/text()"))
    text = F.xpath_string(x, F.lit("//*[local-name()='Reason']/*[local-name()='text']/text()"))
    status = F.when(is_gen & ~is_ack, "ok").when(is_ack, "ack").otherwise("other")
    keep = [c for c in docs.columns if keep_document or c != xml_col]
    return docs.select(*keep, status.alias("status"),
                       F.when(is_ack, F.nullif(code, F.lit(""))).alias("reason_code"),
                       F.when(is_ack, F.nullif(text, F.lit(""))).alias("reason_text"))


# --- building documents from silver rows (round-trip fixtures) ---------------------------------

POINTS_PER_DOCUMENT = 100_000


def _chunk() -> Column:
    """Input split and chunk of it as one number: monotonically_increasing_id counts the rows of a split."""
    return F.floor(F.monotonically_increasing_id() / POINTS_PER_DOCUMENT)


def _fmt(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm'Z'")


def _documents(points: DataFrame, resolution: str) -> DataFrame:
    """(country, psr_type, date, split, position, q) -> one document per (country, date, split), a TimeSeries per PSR
    code with one period that starts at midnight."""
    point = F.concat(F.lit("<Point><position>"), F.col("position").cast("string"), F.lit("</position><quantity>"),
                     F.col("q").cast("string"), F.lit("</quantity></Point>"))
    series = points.groupBy("country", "date", "split", "psr_type").agg(
        F.concat_ws("", F.collect_list(point)).alias("points"))
    start = F.col("date").cast("timestamp")
    series_xml = F.concat(
        F.lit("<TimeSeries><MktPSRType><psrType>"), F.col("psr_type"), F.lit("</psrType></MktPSRType><Period>"),
        F.lit("<timeInterval><start>"), _fmt(start), F.lit("</start><end>"),
        _fmt(start + F.expr("INTERVAL 1 DAY")), F.lit("</end></timeInterval>"),
        F.lit(f"<resolution>{resolution}</resolution>"), F.col("points"), F.lit("</Period></TimeSeries>"))
    docs = series.groupBy("country", "date", "split").agg(F.concat_ws("", F.collect_list(series_xml)).alias("body"))
    return docs.select(
        "country", "date",
        F.concat(F.lit(f'<{GENERATION_ROOT} xmlns="{GENERATION_NS}">'), F.col("body"),
                 F.lit(f"</{GENERATION_ROOT}>")).alias("xml"))


def generation_documents(rows: DataFrame) -> DataFrame:
    """Silver actual-generation rows -> one document per (country, day, chunk): PT15M, position =
    quarter-hour of the day + 1.

    A chunk of POINTS_PER_DOCUMENT rows of an input split (``spark_partition_id`` of the scan, deterministic for
    file scans) is part of the document key, so a document is small even when a single country-day
    dominates the table."""
    ts = gf.epoch_ns_to_ts("timestamp")
    return _documents(rows.where(F.col("domain") == "generation").select(
        "country", "psr_type", F.to_date(ts).alias("date"), _chunk().alias("split"),
        (F.hour(ts) * 4 + F.floor(F.minute(ts) / 15) + 1).cast("int").alias("position"), F.col("actual_MW").alias("q")),
        "PT15M")


def forecast_documents(rows: DataFrame) -> DataFrame:
    """Silver forecast rows -> one day-ahead document per (country, day, chunk): hourly points, position = hour of
    day + 1."""
    ts = gf.epoch_ns_to_ts("timestamp")
    return _documents(rows.where(F.col("domain") == "forecast").select(
        "country", "psr_type", F.to_date(ts).alias("date"), _chunk().alias("split"),
        (F.hour(ts) + 1).alias("position"), F.col("forecast_MW").alias("q")), "PT60M")


def acknowledgement_document(code: Column, text: Column) -> Column:
    return F.concat(F.lit(f"<{ACK_ROOT}><Reason><code>"), code, F.lit("</code><text>"), text,
                    F.lit(f"</text></Reason></{ACK_ROOT}>"))


def union_generation(*frames: DataFrame) -> DataFrame:
    """Actual and forecast rows (and any per-file frames) as one table; columns missing in a
    frame are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_documents(docs: DataFrame, root: str) -> None:
    """Land documents as XML files under ``root/country=../month=..`` with Spark's XML writer
    (root element GL_MarketDocument, one TimeSeries element per series).  A month's documents share files: a file for each day
    of a country would be a few dozen points long."""
    series = decode_documents(docs).select("series.MktPSRType", "series.Period", "country",
                                           F.trunc("date", "month").alias("month"))
    (series.hint("rebalance", "country", "month").write.mode("overwrite").format("xml").option("rootTag", GENERATION_ROOT)
     .option("rowTag", "TimeSeries").partitionBy("country", "month").save(root))


def read_document_tree(spark: SparkSession, root: str) -> DataFrame:
    """Scan a landed document tree with the XML source (row tag TimeSeries); the country comes from the partition folders, the
    date from the series' first period."""
    raw = (spark.read.format("xml").option("rowTag", "TimeSeries").option("ignoreNamespace", "true")
           .schema(SERIES_DDL + ", country string, month date").load(root))
    start = F.try_element_at("Period", F.lit(1))["timeInterval"]["start"]
    return raw.select(F.struct("MktPSRType", "Period").alias("series"), "country", F.to_date(gf.parse_xml_time(start)).alias("date"))
