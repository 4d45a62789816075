import base64
import hashlib
import io

import pytest

from supplyscope.llm import warc_chunks as W
from supplyscope.session import scratch_path

PAGES = "page_id long, url string, html string, data string, record int, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], PAGES)


def check(spark, rows, chunk):
    root = scratch_path(spark, "test-warc")
    got = W.read_archives(W.archive_pages(pages(spark, rows), root, chunk=chunk), root).collect()
    sha = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (i is None, i or 0, len((h or "").encode()), sha(h)) for i, _, h in rows)
    by = {}
    for i, _, h in rows:
        by.setdefault(sha(h), []).append(i)
    for d, ids in by.items():
        mine = [r for r in got if r.payload_digest == d]
        top = max((i for i in ids if i is not None), default=None)
        assert [r.page_id for r in mine if r.record_type == "response"] == [top]
        assert all(r.refers_to == top for r in mine if r.record_type == "revisit")
        assert all(r.refers_to is None for r in mine if r.record_type == "response")


ROWS = [(1, "http://a/ b\r\nX: y", "<html>é</html>"), (2, None, "<html>é</html>"), (3, "", None), (4, "u", ""),
        (5, "u", "WARC/1.1\r\n\r\n" * 50), (6, "u", "long \r\n\r\n" * 20000), (7, "u", "x"), (7, "u", "x"), (None, "u", "z"),
        (None, "u", "x"), (-3, "u", "漢" * 100)]


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_round_trip(spark, chunk):
    check(spark, ROWS, chunk)


def test_hot_payload(spark):
    check(spark, [(i, "u", "same" if i % 3 else f"p{i}") for i in range(200)], 64)


def test_chunks_carry_running_digests(spark):
    rows = W.chunk_table(pages(spark, ROWS), chunk=16).collect()
    for r in {x.record for x in rows}:
        mine = sorted((x for x in rows if x.record == r), key=lambda x: x.chunk_no)
        assert [x.chunk_no for x in mine] == list(range(mine[0].chunks)) and all(len(x.data) <= 16 for x in mine)
        sha = hashlib.sha1()
        for x in mine:
            sha.update(x.data)
            assert x.digest == base64.b32encode(sha.digest()).decode()


def test_damage_is_noticed():
    import zlib

    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(zlib.compress(b"WARC/1.1\r\nWARC-Type: response", wbits=31))))
    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(zlib.compress(b"HTTP/1.1 200\r\n\r\nx\r\n\r\n", wbits=31))))


def test_empty_table(spark):
    root = scratch_path(spark, "test-warc")
    assert W.read_archives(W.archive_pages(pages(spark, []), root), root).count() == 0
