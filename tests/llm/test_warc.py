import base64
import hashlib

from plumeline.llm import warc
from plumeline.session import scratch_path


def pages(spark):
    rows = [(1, "http://a/1", "<p>é</p>\r\n\r\n<p>x</p>", 0), (2, "http://a/2", None, 0), (3, None, "", 1),
            (4, "http://a/\r\n4", "<p>é</p>\r\n\r\n<p>x</p>", 1), (None, "u", "solo", 2), (5, "http://b", "y" * 9_000_000, 3),
            (6, "http://c", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", 4)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, _digest int")


def test_round_trip(spark):
    df = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df, path)
    index = warc.build_index(spark, path)
    assert index.count() == 7
    got = {r.page_id: r for r in warc.read_records(index).collect()}
    for row in df.collect():
        key = "" if row.page_id is None else str(row.page_id)
        payload = (row.html or "").encode()
        record = got[key]
        assert record.payload_bytes == len(payload)
        assert record.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        refers = {"1": "4", "2": "3"}.get(key)
        assert (record.record_type, record.refers_to) == ("revisit" if refers else "response", refers)
        assert record.payload == (None if refers else payload.decode())
    assert got["4"].url == "http://a/%0D%0A4" and got["3"].url is None
    # Only some records: the others are read over or left out.
    some = warc.read_records(index.filter("page_id in ('1', '5')")).collect()
    assert sorted(r.page_id for r in some) == ["1", "5"]


def test_empty_and_repeated(spark):
    df = pages(spark)
    assert warc.archive_and_read(df.limit(0)).count() == 0
    twice = df.filter("page_id = 4").union(df.filter("page_id = 4"))
    assert [r.record_type for r in warc.archive_and_read(twice).collect()] == ["response"] * 2
