import hashlib

from filegate.llm.staging import shared_path
from filegate.llm.warc import coalesce_ranges, read_records, warc_round_trip, write_archives

HTML = ["<p>" + "x" * 1200, "short", None, "", "ünï\r\n\r\nWARC/1.0 " + "y" * 3000]


def pages(spark):
    rows = [(i, f"http://h/{i}\r\nx" if i % 4 else None, HTML[i % 5], "extra", 1) for i in range(60)]
    rows += [rows[55], (None, None, HTML[0], None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, offset string, payload_bytes int")


def expected(rows):
    out = []
    for r in rows:
        raw = (r["html"] or "").encode()
        same = [x["page_id"] for x in rows if (x["html"] or "").encode() == raw and x["page_id"] is not None]
        original = max(same, default=None) if len(raw) >= 1000 else None
        refers = None if original is None or original == r["page_id"] else original
        out.append((r["page_id"], len(raw), hashlib.sha1(raw).hexdigest(),
                    "response" if refers is None else "revisit", refers))
    return sorted(map(repr, out))


def test_round_trip(spark):
    df = pages(spark)
    got = sorted(repr(tuple(r)) for r in warc_round_trip(df).collect())
    assert got == expected(df.collect())
    assert warc_round_trip(df.limit(0)).collect() == []


def test_selected_records_keep_their_payload(spark):
    folder = shared_path(spark, "warc-test")
    index = write_archives(pages(spark), folder, archive_bytes=5000)
    assert index.select("archive").distinct().count() > 1
    picked = index.filter("page_id in ('4', '7', '56', '59')")
    got = {r["page_id"]: r for r in read_records(picked, folder, gap=10, most=2000).collect()}
    assert got["59"]["payload"].decode() == HTML[4] and got["59"]["record_type"] == "response"
    assert got["4"]["refers_to"] == "59" and got["4"]["payload"] is None
    assert got["7"]["payload"] == b"" and got["7"]["url"] == "http://h/7%0D%0Ax"
    assert got["56"]["payload"] == b"short"


def test_ranges():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 50, 10), ("a", 1000, 10), ("b", 0, 10), ("b", 10, 500)]
    assert list(map(len, coalesce_ranges(rows, gap=40, most=100))) == [3, 1, 1, 1]
