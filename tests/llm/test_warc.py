import glob
import gzip
import hashlib

import duckdb
import pytest

from llm_data import SF
from gridmix.llm import queries, warc
from gridmix.session import work_dir

SCHEMA = "page_id long, url string, html string, digest string"


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data, f = (h or "").encode(), first.get(h or "")
        again = len(data) >= 100 and f is not None and i != f
        out.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
                    str(f) if again else "None"))
    return sorted(out)


def got(frame):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to))
                  for r in frame.collect())


BIG = "é<p>" * 40
EDGES = [(1, "http://a", None), (2, "http://b", ""), (3, None, "x" * 99), (4, "u", "x" * 99), (9, "u", BIG), (6, "u", BIG),
         (6, "u", BIG), (None, "u", BIG), (7, "u\r\nX: y", BIG), (None, "u", "z" * 100), (None, "u", "z" * 100),
         (12, "u", "".join(chr(33 + i * i % 9000) for i in range(200_000))), (13, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]


@pytest.mark.parametrize("size", [64, 1000, 1 << 25])
def test_edges(spark, size):
    frame = spark.createDataFrame([(*r, "x") for r in EDGES], SCHEMA)
    assert got(warc.round_trip(frame, work_dir(spark, "archives"), size)) == brute(EDGES)


def test_empty(spark):
    assert got(warc.round_trip(spark.createDataFrame([], SCHEMA), work_dir(spark, "archives"))) == []


def test_payloads_come_back_and_archives_are_gzip(spark):
    folder = work_dir(spark, "archives")
    warc.write_archives(spark.createDataFrame([(*r, "x") for r in EDGES], SCHEMA), folder)
    back = {r.page_id: r for r in warc.read_archives(spark, folder, 500).filter("record_type = 'response'").collect()}
    assert back[12].payload.decode() == EDGES[11][2] and back[2].payload == b"" and back[4].url == "u"
    files = glob.glob(f"{folder.removeprefix('file:').replace('//', '/')}/*.warc.gz")
    data = [gzip.open(f).read() for f in files]  # one stream of members each
    assert sum(d.count(b"WARC-Record-ID: ") for d in data) == len(EDGES)


def test_payload_that_is_an_archive(spark, tmp_path):
    """A record stored without compression shows the magic of the archive that it holds."""
    import zlib

    inner = warc.member(warc.record(99, "inner", b"i" * 500, hashlib.sha256(b"i" * 500).hexdigest(), None, "i"))
    def stored(data):
        c = zlib.compressobj(0, zlib.DEFLATED, 31)
        return c.compress(data) + c.flush()
    records = [warc.record(n, "outer", p, hashlib.sha256(p).hexdigest(), None, str(n))
               for n, p in ((1, b"a" * 300), (2, inner * 3), (3, b"c" * 300))]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(map(stored, records)))
    for size in (100, 700, 1 << 20):
        rows = warc.read_archives(spark, f"file://{tmp_path}", size).collect()
        assert sorted(r.page_id for r in rows) == [1, 2, 3]


def test_query_matches_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    res = c.execute(warc.ORACLE)
    cols = [d[0] for d in res.description]
    rows = queries.QUERIES["op5_warc"](spark, SF).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted((tuple(r[c] for c in cols) for r in rows), key=key) == sorted(res.fetchall(), key=key)
