import json
import os

import pytest
from pyspark.sql import functions as F

from gridmix import dims
from gridmix import functions as gf
from gridmix.sources import config, cube, files
from gridmix.sources import xml as bx

DOC = """<GL_MarketDocument xmlns="urn:x"><TimeSeries><MktPSRType><psrType>B16</psrType></MktPSRType>
<Period><timeInterval><start>2025-03-01T00:00Z</start></timeInterval>
<Point><position>1</position><quantity>5</quantity></Point>
<Point><position>2</position></Point><Point><quantity>3</quantity></Point>
<Point><position>x</position><quantity>3</quantity></Point></Period>
<Period><resolution>PT15M</resolution><Point><position>1</position><quantity>1</quantity></Point></Period>
</TimeSeries><TimeSeries><Period><timeInterval><start>2025-03-01T00:00Z</start></timeInterval>
<resolution>PT15M</resolution><Point><position>3</position><quantity>7.5</quantity></Point></Period></TimeSeries>
</GL_MarketDocument>"""


def _prefixed(doc):
    import re
    d = re.sub(r"<(/?)([A-Za-z])", r"<\1ns2:\2", doc)
    return d.replace('ns2:GL_MarketDocument xmlns=', 'ns2:GL_MarketDocument xmlns:ns2=', 1)


def test_flatten_edge_cases_and_namespaces(spark):
    for doc in (DOC, _prefixed(DOC)):
        docs = spark.createDataFrame([("GR", doc)], "country string, xml string")
        rows = bx.flatten_series(bx.decode_documents(docs), "generation").orderBy("timestamp").collect()
        # missing resolution -> 60 min; missing position / quantity / bad position dropped;
        # period without start dropped; missing psrType -> 'unknown'
        assert [(r["timestamp"].isoformat(), r["psr_type"], r["actual_MW"]) for r in rows] == [
            ("2025-03-01T00:00:00", "B16", 5.0), ("2025-03-01T00:30:00", "unknown", 7.5)]
        assert rows[1]["energy_source"] == "Unknown (unknown)"


def test_forecast_step_is_hourly(spark):
    docs = spark.createDataFrame([("GR", DOC.replace("<timeInterval><start>2025-03-01T00:00Z</start></timeInterval>\n<resolution>PT15M</resolution>", "<timeInterval><start>2025-03-01T00:00Z</start></timeInterval><resolution>PT15M</resolution>"))], "country string, xml string")
    rows = bx.flatten_series(bx.decode_documents(docs), "forecast").orderBy("timestamp").collect()
    assert rows[-1]["timestamp"].isoformat() == "2025-03-01T02:00:00" and rows[-1]["forecast_MW"] == 7.5


def test_triage(spark):
    ack = "<Acknowledgement_MarketDocument><Reason><code>999</code><text>No data</text></Reason></Acknowledgement_MarketDocument>"
    docs = spark.createDataFrame([(1, DOC), (2, ack), (3, "<html/>")], "id int, xml string")
    got = {r["id"]: (r["status"], r["reason_code"], r["reason_text"]) for r in bx.triage(docs).collect()}
    assert got == {1: ("ok", None, None), 2: ("ack", "999", "No data"), 3: ("other", None, None)}


def test_xml_file_scan_with_path_columns(spark, tmp_dir):
    d = os.path.join(tmp_dir, "bronze", "entsoe", "GR", "generation", "2025-03-01")
    os.makedirs(d)
    with open(os.path.join(d, "generation.xml"), "w") as fh:
        fh.write(DOC)
    series = bx.read_series_files(spark, os.path.join(tmp_dir, "bronze"))
    series = files.path_columns(series)
    rows = bx.flatten_series(series, "generation").collect()
    assert sorted(r["actual_MW"] for r in rows) == [5.0, 7.5] and {r["country"] for r in rows} == {"GR"}


def test_path_columns_and_pruning(spark):
    paths = ["bronze/entsoe/GR/generation/2025-03-01/generation.xml", "bronze/entsoe/GR/generation/undated/x.xml",
             "bronze/era5/GR/2025/02/2025-02_wind.nc", "bronze/era5/GR/2025/03/2025-03-05_solar.nc"]
    df = files.path_columns(spark.createDataFrame([(p,) for p in paths], "path string"))
    r = {x["path"]: x for x in df.collect()}
    assert r[paths[2]]["file_max"].isoformat() == "2025-02-28" and r[paths[2]]["category"] == "wind"
    assert r[paths[1]]["file_date"] is None
    lo, hi = F.lit("2025-02-27").cast("date"), F.lit("2025-03-02").cast("date")
    kept = {x["path"] for x in files.prune_by_date(df, lo, hi).collect()}
    assert kept == {paths[0]}
    kept = {x["path"] for x in files.prune_by_overlap(df.where("file_date is null"), lo, hi).collect()}
    assert kept == {paths[2]}


def test_cube_roundtrip_with_hole(spark):
    from helpers import BASE_NS, HOUR, WEATHER_SCHEMA

    rows = [(BASE_NS + t * HOUR, la, lo, "t2m", 280.0 + t + la + lo, "GR")
            for t in range(2) for la in (40.0, 40.25) for lo in (20.0, 20.25)]
    rows = rows[:-1]  # one missing cell
    raw = spark.createDataFrame(rows, WEATHER_SCHEMA)
    cubes = sorted(cube.build_cubes(raw).collect(), key=lambda c: c["time"])  # one per hour
    assert [len(c["values"]) for c in cubes] == [4, 4] and cubes[1]["values"][-1] is None
    back = cube.flatten_cube(spark.createDataFrame(cubes, cube.CUBE_DDL))
    assert back.count() == 7


def test_country_config_json(spark, tmp_dir):
    obj = {code: {"country_name": dims.COUNTRY_NAME[code], "entsoe_areas": [{"code": eic, "label": lab}],
                  "era5_area": list(box)} for code, (eic, lab, box) in dims.COUNTRY_CONFIG.items()}
    p = os.path.join(tmp_dir, "countries.json")
    with open(p, "w") as fh:
        json.dump(obj, fh, indent=2)
    cfg = config.read_country_config(spark, p)
    assert cfg.count() == 8
    areas = {r["country_code"]: r for r in config.country_areas(cfg).collect()}
    assert areas["GR"]["north"] == 41.5 and areas["GR"]["code"] == "10YGR-HTSO-----Y"
    # a point inside two boxes maps to both countries
    cells = spark.createDataFrame([(54.8, 14.5)], "lat double, lon double")
    assert {r["country_code"] for r in cube.grid_to_country(cells, cfg).collect()} == {"DE", "DK", "PL"}


def test_corrupt_documents_and_offsets(spark):
    good = ("<GL_MarketDocument><TimeSeries><MktPSRType><psrType>B16</psrType></MktPSRType><Period><timeInterval>"
            "<start>{}</start></timeInterval><resolution>PT60M</resolution><Point><position>1</position>"
            "<quantity>5</quantity></Point></Period></TimeSeries></GL_MarketDocument>")
    rows = [("utc", good.format("2025-03-01T00:00Z")), ("offset", good.format("2025-03-01T01:00+01:00")),
            ("seconds", good.format("2025-03-01T00:00:00+00:00")), ("naive", good.format("2025-03-01T00:00")),
            ("soon", good.format("soon")), ("cut", good.format("2025-03-01T00:00Z")[:120]), ("none", None)]
    docs = spark.createDataFrame([("GR", k, x) for k, x in rows], "country string, k string, xml string")
    out = bx.flatten_series(bx.decode_documents(docs)).collect()
    assert len(out) == 4 and len({r.timestamp for r in out}) == 1
    assert {(r.k, r.reason, r.n) for r in bx.rejects(docs).collect()} == {
        ("soon", "bad_start", 1), ("cut", "corrupt", 1), ("none", "corrupt", 1)}


def test_weather_reader(spark):
    import math

    from gridmix import functions as gf
    from gridmix.sources import weather

    rows = [("2025-03-01 00:00:00", "40.0", 20.0, "2m_temperature", "280.5", "GR"),
            ("2025-03-01T01:00Z", "40.0", 20.0, "u100", " 1 ", "GR"), ("never", "40", 20.0, "u100", "1", "GR"),
            ("2025-03-01 00:00:00", "x", 20.0, "u100", "1", "GR"), ("2025-03-01 00:00:00", "40", math.nan, "u100", "1", "GR"),
            ("2025-03-01 00:00:00", "40", 20.0, "u100", "NaN", "GR"), ("2025-03-01 00:00:00", "40", 20.0, "u100", None, "GR")]
    raw = spark.createDataFrame(rows, "valid_time string, latitude string, longitude double, variable string, value string, country string")
    out = weather.to_silver_weather(raw).collect()
    assert sorted((r.variable, r.value) for r in out) == [("t2m", 280.5), ("u100", 1.0)]
    with pytest.raises(gf.MissingColumnsError, match="value"):
        weather.to_silver_weather(raw.drop("value"))
    wide = weather.rename_wide(raw.withColumnRenamed("value", "total_precipitation"))
    assert {"timestamp", "lat", "lon", "tp"} <= set(wide.columns)


def test_averages_don_t_overflow(spark):
    df = spark.range(3_000_000).selectExpr("3.6e6D + (id % 2) as x")
    assert df.agg(gf.exact_avg("x", 6, 6).alias("m")).first()[0] == 3_600_000.5
    assert spark.createDataFrame([(-1.005,), (-1.015,)], "x double").agg(gf.exact_avg("x", 3, 2).alias("m")).first()[0] == -1.01


def test_document_files_grow_with_months(spark, tmp_dir):
    """A folder a country and month; every series comes back with its country and day."""
    rows = spark.range(40 * 2).selectExpr(
        "1740787200000000000 + (id div 2) * 86400000000000 as timestamp", "if(id % 2 = 0, 'GR', 'FR') as country", "'Solar' as energy_source",
        "'B16' as psr_type", "cast(id as double) as actual_MW", "cast(null as double) as forecast_MW", "'generation' as domain")
    root = os.path.join(tmp_dir, "tree")
    bx.write_documents(bx.generation_documents(rows), root)
    assert sorted(os.listdir(os.path.join(root, "country=FR"))) == ["month=2025-03-01", "month=2025-04-01"]
    assert len(bx.read_document_tree(spark, root).inputFiles()) == 4
    assert {(r.country, str(r.date)) for r in bx.read_document_tree(spark, root).collect()} == {
        (r.country, str(r.day)) for r in rows.selectExpr("country", "date(timestamp_micros(timestamp div 1000)) as day").collect()}


def test_days_of_documents_come_from_folders(spark, tmp_dir):
    """First and last day without reading a document; a short range's other days aren't listed."""
    docs = spark.createDataFrame([("GR", "2025-03-01", "<a/>"), ("GR", "2025-03-09", "<b/>"), ("FR", "2025-03-12", "<c/>"), ("FR", None, "<d/>")],
                                 "country string, date string, xml string").selectExpr("country", "date(date) as date", "xml")
    root = os.path.join(tmp_dir, "docs")
    assert bx.document_days(spark, root) == (None, None)
    bx.land_documents(docs, root, "generation")
    assert [str(d) for d in bx.document_days(spark, root)] == ["2025-03-01", "2025-03-12"]
    assert [str(d) for d in bx.document_days(spark, root, "GR", "generation")] == ["2025-03-01", "2025-03-09"]
    assert bx.read_documents(spark, root).count() == 4
    some = bx.read_documents(spark, root, "2025-03-01", "2025-03-09")
    assert sorted(r.xml.strip() for r in some.collect()) == ["<a/>", "<b/>"] and len(some.inputFiles()) == 2
    assert bx.read_documents(spark, root, "2025-04-01", "2025-04-02").count() == 0
    assert {str(r.date) for r in some.collect()} == {"2025-03-01", "2025-03-09"}


PACKED_DOCS = ("select explode(array('GR', 'FR', null)) as country, if(id = 40, null, date_add(date'2025-03-01', cast(id as int))) as date, 'generation' as domain, "
               "concat('<a>', id, '</a>') as xml from range(41)")


def _documents(df):
    return sorted((str(r.country), str(r.date), r.domain, r.xml.strip()) for r in df.collect())


def test_packed_documents_grow_with_months(spark, tmp_dir):
    """A folder a month, not a file a document; the rows are those of a tree with a file each, of a range too."""
    docs = spark.sql(PACKED_DOCS)
    packed, own = os.path.join(tmp_dir, "packed"), os.path.join(tmp_dir, "own")
    bx.pack_documents(docs, packed)
    bx.land_documents(docs.where("date < '2025-03-04' or date is null"), own, "generation")
    got = bx.read_documents(spark, packed)
    assert len(got.inputFiles()) == 3 and _documents(got) == _documents(docs)
    assert _documents(got.where("date < '2025-03-04' or date is null")) == _documents(bx.read_documents(spark, own))
    assert len({r.path for r in got.collect()}) == 41 * 3
    some = docs.where("date between '2025-03-30' and '2025-04-02'")
    for start, end in (("2025-03-30", "2025-04-02"), (F.lit("2025-03-30").cast("date"), F.lit("2025-04-02").cast("date"))):
        assert _documents(bx.read_documents(spark, packed, start, end)) == _documents(some)
    assert [str(d) for d in bx.document_days(spark, packed)] == ["2025-03-01", "2025-04-09"]
    assert bx.document_days(spark, packed, "GR", "forecast") == (None, None)


def test_own_files_replace_packed_documents(spark, tmp_dir):
    docs = spark.sql(PACKED_DOCS)
    bx.pack_documents(docs, tmp_dir)
    new = docs.where("country = 'GR' and (date = '2025-03-05' or date is null)").withColumn("xml", F.lit("<b/>"))
    bx.land_documents(new.unionByName(new.selectExpr("country", "date_add(date, 365) as date", "domain", "xml").where("date is not null")),
                      tmp_dir, "generation")
    got = _documents(bx.read_documents(spark, tmp_dir))
    assert len(got) == 41 * 3 + 1 and [r[:2] for r in got if r[3] == "<b/>"] == [("GR", "2025-03-05"), ("GR", "2026-03-05"), ("GR", "None")]
    assert [r[3] for r in _documents(bx.read_documents(spark, tmp_dir, "2025-03-05", "2025-03-05"))] == ["<a>4</a>", "<b/>", "<a>4</a>"]
    assert [str(d) for d in bx.document_days(spark, tmp_dir)] == ["2025-03-01", "2026-03-05"]


def test_large_documents_share_no_row_group(spark, tmp_dir, monkeypatch):
    """A group of rows is bounded by bytes, also where its first hundred rows are far more than that."""
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(bx, "PACKED_GROUP_BYTES", 1 << 20)
    docs = spark.range(20).selectExpr("'GR' as country", "date'2025-03-01' as date", "'generation' as domain",
                                      "array_join(transform(sequence(1, 60000), i -> hash(id, i)), ' ') as xml").coalesce(1)
    bx.pack_documents(docs, tmp_dir)
    groups = [m.row_group(i) for f in glob.glob(f"{tmp_dir}/_packed/*/*.parquet") for m in [pq.ParquetFile(f).metadata]
              for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 20 and max(g.num_rows for g in groups) <= 4
    assert bx.read_documents(spark, tmp_dir).selectExpr("sum(length(xml))").first()[0] == docs.selectExpr("sum(length(xml))").first()[0]
