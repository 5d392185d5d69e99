import base64
import collections
import hashlib
import pathlib

import pytest

from salescast.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def brute(rows, least=0):
    """The rows that must come back, from the definition."""
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    same = collections.defaultdict(list)
    for r in rows:
        same[r[2] or ""].append(r)
    out = []
    for text, group in same.items():
        for i, r in enumerate(sorted(group, key=order)):
            alone = len(text.encode()) < least or not i
            out.append((r[0], len(text.encode()), digest(text), "response" if alone else "revisit",
                        None if alone else min(group, key=order)[0]))
    return collections.Counter(out)


def back(frame, least=0):
    return collections.Counter(tuple(r) for r in warc.round_trip(frame, least).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def plain_read(folder):
    """All records of a folder by a plain reader that follows the lengths."""
    out = []
    for p in pathlib.Path(folder).glob("part-*"):
        data, at = p.read_bytes(), 0
        while at < len(data):
            stop = data.index(b"\r\n\r\n", at)
            first, *lines = data[at:stop].decode().split("\r\n")
            assert first == "WARC/1.1"
            head = dict(x.split(": ", 1) for x in lines)
            end = stop + 4 + int(head["Content-Length"])
            assert data[end:end + 4] == b"\r\n\r\n"
            block = data[stop + 4:end]
            out.append((head, block.split(b"\r\n\r\n", 1)[1]))
            at = end + 4
    return out


ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, None, None), (3, "http://b/\r\nX: y", ""), (None, "http://c/", "<p>one</p>"), (None, None, None),
    (4, "u", "é" * 3000), (5, "u", "x\r\n\r\n" + FAKE + "y"), (6, "u", "\n" + FAKE * 40), (7, "u", FAKE), (8, "u", "\r\n\r\n" + FAKE + FAKE),
    (9, "http://e/WARC/1.1", "z"), (10, "u", "\n" + FAKE * 40), (11, "u", "\nWARC/1.1\r\nContent-Length: 99999999\r\n\r\n"),
    (12, "u", "\nWARC/1.1\r\nContent-Length: 1"), (13, "u", "\nWARC/WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (14, "u", "\r\n\r\n" * 30),
    (4, "u", "é" * 3000), (4, "u", "é" * 3000), (4, "v", "é" * 3000), (15, "u", "中\U0001f600"), (16, "u", "\nWARC/" * 50),
]


@pytest.mark.parametrize("parts, block", [(3, None), (1, 700), (2, 137)])
def test_marks_in_payloads_and_cut_files(spark, parts, block):
    key = "spark.sql.files.maxPartitionBytes"
    if block:
        spark.conf.set(key, str(block))
    try:
        assert back(frame(spark, ROWS).repartition(parts)) == brute(ROWS)
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("least", [1, 11, 6000, 10**6])
def test_small_payloads_are_responses(spark, least):
    assert back(frame(spark, ROWS), least) == brute(ROWS, least)


def test_files_hold_standard_records(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(frame(spark, ROWS), folder)
    found = plain_read(folder)
    assert len(found) == len(ROWS) and len({h["WARC-Record-ID"] for h, _ in found}) == len(ROWS)
    payload = {h["WARC-Record-ID"]: p for h, p in found if h["WARC-Type"] == "response"}
    assert len(payload) == len({r[2] or "" for r in ROWS})
    got = collections.Counter()
    for h, p in found:
        if h["WARC-Type"] == "revisit":
            assert p == b"" and "WARC-Profile" in h
            p = payload[h["WARC-Refers-To"]]
        assert h["WARC-Payload-Digest"] == "sha1:" + digest(p.decode())
        got[h.get("X-Page-Id"), p.decode()] += 1
    assert got == collections.Counter((None if r[0] is None else str(r[0]), r[2] or "") for r in ROWS)


def test_foreign_records(spark, tmp_path):
    """Other versions, header cases, record types without HTTP, and a mark at the very end."""
    data = (b"WARC/1.0\r\nwarc-type: warcinfo\r\ncontent-length:  3 \r\n\r\nabc\r\n\r\n"
            b"WARC/1.1\r\nWARC-Type: resource\r\nX-Page-Id: 5\r\nContent-Type: text/html\r\nContent-Length: 7\r\n\r\na\r\n\r\nbc\r\n\r\n"
            b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 6\r\n\r\n\nWARC/\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    got = sorted((r.at, r.record_type, r.page_id, r.payload_bytes) for r in warc.read(spark, str(tmp_path)).collect())
    starts = [0, data.index(b"WARC/1.1"), data.rindex(b"WARC/1.1")]
    assert got == list(zip(starts, ["warcinfo", "resource", "resource"], [None, 5, None], [3, 7, 6], strict=True))


@pytest.mark.parametrize("cut", [(0, -3), (1, None), (0, 40)])
def test_damaged_files_raise(spark, tmp_path, cut):
    folder = tmp_path / "w"
    warc.write(frame(spark, ROWS[:1]), str(folder))
    data = max((p.read_bytes() for p in folder.glob("part-*")), key=len)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.warc").write_bytes(data[cut[0]:cut[1]])
    with pytest.raises(ValueError, match="chain"):
        warc.read(spark, str(tmp_path / "bad"))
    (tmp_path / "bad" / "x.warc").write_bytes(data.replace(b"one", b"two"))
    with pytest.raises(ValueError, match="digest"):
        warc.read(spark, str(tmp_path / "bad"))


def test_hot_payload_and_clashing_columns(spark):
    rows = [(i, f"u{i % 7}", "same" if i % 3 else f"own {i}") for i in range(3000)] + [(1, "u1", "same")] * 2500
    from pyspark.sql import functions as F

    wide = frame(spark, rows).select("*", *[F.lit(1).alias(c) for c in ("sha", "size", "first", "ties", "n", "key", "text", "at", "value")])
    assert back(wide) == brute(rows)
    assert warc.round_trip(wide.limit(0)).count() == 0


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert back(pages) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
