"""Archives written, read back, and read by others' rules."""

import base64
import gzip
import hashlib
import os
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from refinery.llm import spread, warc
from support import rows

SCHEMA = "page_id long, url string, html string"


def new_path():
    return f"{tempfile.mkdtemp(prefix='warc-')}/archive"


def brute(data, min_bytes=0):
    """Rows that repeat an id and a payload are alike in the result, so any of them may be the response."""
    groups, out = defaultdict(list), []
    for page, _, html in data:
        raw = (html or "").encode()
        groups[raw].append(page)
    for raw, pages in groups.items():
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        best = max(pages, key=lambda p: (p is not None, p or 0))
        left = list(pages)
        if len(raw) >= min_bytes:
            left.remove(best)
            out.append((best, len(raw), digest, "response", None))
            out += [(p, len(raw), digest, "revisit", best) for p in left]
        else:
            out += [(p, len(raw), digest, "response", None) for p in left]
    text = [tuple(None if v is None else str(v) if i in (0, 4) else v for i, v in enumerate(r)) for r in out]
    return sorted(text, key=lambda r: tuple((v is None, str(v)) for v in r))


def data():
    out = [(i, f"http://x/{i}", f"<p>page {i}</p>") for i in range(60)]
    out += [(100 + i, "http://same/", "<p>the same</p>") for i in range(80)]
    out += [(200, None, None), (201, "", ""), (202, "http://a\r\nWARC-Type: fake", "\r\n\r\nWARC/1.1\r\n"), (-5, "u", "<p>the same</p>")]
    out += [(300, "http://b/", "twice")] * 3 + [(None, "n", "nobody"), (None, "n", "nobody"), (None, "n", "<p>page 3</p>")]
    out += [(400, "long", "ü𝄞 long " * 300_000), (401, "long", "ü𝄞 long " * 300_000), (402, "bin", "\0\x1f\x8b")]
    return out


@pytest.mark.parametrize(("min_bytes", "level"), [(0, 6), (0, 0), (10, 1)])
def test_brute_force(spark, min_bytes, level, monkeypatch):
    monkeypatch.setattr(warc, "HOT_ROWS", 10)
    made, path = data(), new_path()
    df = spark.createDataFrame(made, SCHEMA).repartition(4)
    warc.write_archive(df, path, min_bytes=min_bytes, level=level, cut_bytes=2_000)
    assert rows(warc.archived_pages(spark, path)) == brute(made, min_bytes)
    small = warc.read_archive(spark, path, "record_id string, payload binary", split_bytes=4_000)
    assert small.rdd.getNumPartitions() > warc.read_archive(spark, path).rdd.getNumPartitions()
    texts = {(r.page, r.text) for r in small.where("record_id is not null").select(warc.page_of(F.col("record_id")).alias("page"), F.decode("payload", "UTF-8").alias("text")).collect()}
    assert {(str(p), t or "") for p, _, t in made if p in (5, 200, 202, 401, 402)} <= texts


def test_a_payload_that_the_bitmap_marks_by_chance_is_a_response(spark, monkeypatch):
    monkeypatch.setattr(spread.marked, "__defaults__", (4,))
    made, path = data(), new_path()
    warc.write_archive(spark.createDataFrame(made, SCHEMA), path)
    assert rows(warc.archived_pages(spark, path)) == brute(made)


def test_predicates_reach_the_reader_and_blocks_are_skipped(spark, monkeypatch):
    path = new_path()
    warc.write_archive(spark.createDataFrame(data(), SCHEMA), path)
    df = warc.read_archive(spark, path, "warc_type string, target_uri string, payload binary")
    wanted = df.where("warc_type = 'response' and target_uri like 'http://x/1%' and target_uri is not null")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan warc" in plan and "Filter " not in plan  # Spark filters nothing again
    assert "Filter " in df.where("payload is null")._jdf.queryExecution().executedPlan().toString()
    assert wanted.count() == 11
    reader = warc._Reader(path, df.schema, {})
    from pyspark.sql.datasource import EqualTo, In, IsNull, Not

    later = [EqualTo(("payload",), b"x"), IsNull(("file",))]
    assert list(reader.pushFilters([EqualTo(("warc_type",), "revisit"), Not(In(("target_uri",), ("http://same/",))), *later])) == later
    taken = []
    monkeypatch.setattr(warc._Record, "block", lambda self: taken.append(self.offset) or b"")
    found = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in found) == len(taken) == sum(
        1 for r in warc.read_archive(spark, path, "warc_type string, target_uri string").collect() if r.warc_type == "revisit" and r.target_uri is not None and r.target_uri != "http://same/"
    )


def test_long_block_is_not_inflated_when_skipped():
    record = warc._record({"payload": os.urandom(1 << 22), "warc_type": "response", "record_id": "<urn:a>", "target_uri": None, "refers_to": None}, "2024-01-01T00:00:00Z")
    packed = warc._member(record, 6)
    assert gzip.decompress(packed) == record
    import pyarrow as pa

    both = pa.BufferReader(packed + packed)
    one = warc._Record(both, 0)
    assert one.next() == len(packed) and len(one.plain) < 1 << 17
    assert one.payload_length() == 1 << 22 and len(one.plain) < 1 << 17
    assert warc._Record(both, one.next()).payload() == one.payload()


def test_archives_of_others(spark):
    folder = new_path()
    os.makedirs(folder)
    block = b"software: x\r\n"
    info = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:1>\r\nX-Note: folded\r\n  line\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody"
    page = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:2>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(http), http)
    with open(f"{folder}/a.warc.gz", "wb") as file:
        file.write(gzip.compress(info) + gzip.compress(page))
    with open(f"{folder}/b.warc", "wb") as file:
        file.write(info + page)
    with open(f"{folder}/notes.txt", "w") as file:
        file.write("no archive")
    found = warc.read_archive(spark, folder, "warc_type string, x_note string, payload_length long, payload binary, headers map<string,string>")
    got = [(r.warc_type, r.x_note, r.payload_length, bytes(r.payload), r.headers["WARC-Record-ID"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted([("warcinfo", "folded line", len(block), block, "<urn:1>"), ("response", None, 4, b"body", "<urn:2>")] * 2, key=str)
    assert warc.read_archive(spark, f"file://{folder}/b.warc").count() == 2
    with open(f"{folder}/c.warc.gz", "wb") as file:
        file.write(gzip.compress(info + page))
    with pytest.raises(Exception, match="member of its own"):
        warc.read_archive(spark, f"{folder}/c.warc.gz").count()


def test_only_listed_files_count(spark):
    path = new_path()
    df = spark.createDataFrame(data()[:20], SCHEMA)
    warc.write_archive(df, path)
    with open(f"{path}/part-lost.warc.gz", "wb") as file:
        file.write(b"half a record")
    assert warc.archived_pages(spark, path).count() == 20
    warc.write_archive(spark.createDataFrame(data()[20:30], SCHEMA), path)
    assert warc.archived_pages(spark, path).count() == 30


def test_damaged_payload_is_noticed(spark):
    path = new_path()
    warc.write_archive(spark.createDataFrame([(1, "u", "abcdef")], SCHEMA), path, level=0)
    [name] = [n for n in os.listdir(path) if n.startswith("part-")]
    with open(f"{path}/{name}", "rb") as file:
        raw = file.read()
    with open(f"{path}/{name}", "wb") as file:
        file.write(raw.replace(b"abcdef", b"abcdeg"))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.archived_pages(spark, path).collect()


def test_empty_table_and_clashing_columns(spark):
    path = new_path()
    warc.write_archive(spark.createDataFrame([], SCHEMA), path)
    assert warc.archived_pages(spark, path).count() == 0
    made = data()
    more = spark.createDataFrame([(*r, "x", 1, 2) for r in made], SCHEMA + ", digest string, payload int, id long")
    path = new_path()
    warc.write_archive(more, path)
    assert rows(warc.archived_pages(spark, path)) == brute(made)
    path = new_path()
    warc.write_archive(spark.createDataFrame([("a b>", "u", "x"), ("é", "u", "x")], "page_id string, url string, html string"), path)
    assert rows(warc.archived_pages(spark, path).select("page", "refers_to")) == [("a b>", "é"), ("é", None)]
