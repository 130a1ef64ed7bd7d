import glob
import hashlib
import base64

import pytest
import zstandard

from wardflow.llm import warc
from wardflow.session import work_path

SCHEMA = "page_id bigint, url string, html string, payload string"
ROWS = [
    (1, "http://a/b?c=d e", "<p>é</p>", "x"), (7, None, "<p>é</p>", "x"), (3, "u\r\nX: y", None, None),
    (4, "http://ü/", "", None), (None, "n", "", None), (8, "l", "z" * 300_000, None),
    (9, "m", "WARC/1.1\r\n\r\n", None), (10, "o", "z" * 300_000, None), (10, "o", "z" * 300_000, None),
] + [(100 + i, "h", "hot", None) for i in range(50)]


def expected(min_bytes=0):
    best = {}
    for i, _, html, _ in ROWS:
        key = (html or "").encode()
        best[key] = max(best.get(key, -1), -1 if i is None else i)
    out = []
    for i, _, html, _ in ROWS:
        body = (html or "").encode()
        again = len(body) >= min_bytes and best[body] != (-1 if i is None else i)
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if again else "response", best[body] if again else None))
    return sorted(map(str, out))


def test_round_trip_equals_brute_force(spark, frame):
    for min_bytes in (0, 5):
        path = work_path(spark, "warc")
        warc.write_archives(frame(ROWS, SCHEMA), path, "page_id", "url", "html", min_bytes)
        rows = warc.read_archives(spark, path).collect()
        got = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
        assert sorted(map(str, got)) == expected(min_bytes)
        texts = {r.id: bytes(r.payload).decode() for r in rows if r.record_type == "response"}
        assert texts[8 if min_bytes > 300_000 else 10] == "z" * 300_000
        assert {r.url for r in rows} == {u or "" for _, u, _, _ in ROWS}


def test_archives_are_plain_zstandard_with_a_leading_dictionary(spark, frame):
    path = work_path(spark, "warc")
    warc.write_archives(frame(ROWS, SCHEMA), path, "page_id", "url", "html")
    (first, *_) = glob.glob(path + "/part-*")
    content = open(first, "rb").read()
    assert content[:4] == b"\x5d\x2a\x4d\x18"
    assert all(r.startswith(b"WARC/1.1\r\n") for r in warc.archive_records(content))


def test_empty_table(spark, frame):
    path = work_path(spark, "warc")
    warc.write_archives(frame([], SCHEMA), path, "page_id", "url", "html")
    assert warc.read_archives(spark, path).count() == 0


GOOD = warc.record_bytes(1, "http://a", b"body", None, False)


@pytest.mark.parametrize("record", [
    GOOD[:-1], GOOD + b"x", GOOD.replace(b"WARC/1.1", b"WARC/9.9"),
    GOOD.replace(b"WARC-Date", b"Date"), GOOD.replace(b"body", b"bodi"),
    GOOD.replace(b"Content-Length: 4", b"Content-Length: 5"), GOOD.replace(b"response\r", b"other\r", 1),
    b"WARC/1.1\r\nno colon\r\n\r\n", b"nothing",
])
def test_bad_records_are_refused(record):
    with pytest.raises(warc.BadRecord):
        warc.parse(record)
    content = zstandard.ZstdCompressor().compress(GOOD) + zstandard.ZstdCompressor().compress(record)
    rows = list(warc._rows(content, keep_bad=True))
    assert len(rows) == 2 and rows[0][7] is None and rows[1][7]


def test_a_cut_archive_is_reported():
    content = zstandard.ZstdCompressor().compress(GOOD)
    for cut in (3, 10, len(content) - 1):
        rows = list(warc._rows(content[:cut], keep_bad=True))
        assert rows[-1][7]
        with pytest.raises(warc.BadRecord):
            list(warc._rows(content[:cut], keep_bad=False))
