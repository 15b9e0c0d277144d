import gzip
import hashlib
import os
import random

import pytest

from spendlens.llm import warc
from spendlens.llm.common import work_folder

PAGES = "page_id bigint, url string, html string"


def test_framing_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 9, 10, 11, 5000):
        body = bytes(rng.randrange(256) for _ in range(n))
        assert warc.unframed(warc.framed(body, 10)) == body
    assert warc.unframed(b"5;name=x\r\nhello\r\n0\r\nTrailer: 1\r\n\r\n") == b"hello"
    for broken in (b"", b"5\r\nhell", b"4\r\nhello\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unframed(broken)


@pytest.fixture
def pages(spark):
    big, small = "é<p>" * 2000, "tiny"
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, big), (2, None, big), (None, "u", big), (3, "u", small),
            (4, "u", small), (5, "u", None), (6, "u", ""), (7, "u", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 60),
            (None, "v", "lone" * 500), (None, "w", "lone" * 500), (8, "x", "z" * 1000), (9, "x", "z" * 1000)]
    return spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("segment", [100, 1 << 14])
def test_round_trip(spark, pages, segment):
    folder = work_folder(spark, "test-warc")
    warc.write_archives(pages.selectExpr("*", "1 AS digest", "2 AS payload"), folder, segment=segment)
    got = sorted(
        ((r.page_id or 0, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, r.problem)
         for r in warc.read_archives(spark, folder).collect()), key=repr)
    want = []
    first = {}
    for r in pages.collect():
        data = (r.html or "").encode()
        if r.page_id is not None:
            first[data] = max(first.get(data, 0), r.page_id)
    for r in pages.collect():
        data = (r.html or "").encode()
        refers = first.get(data) if len(data) >= 1000 and first.get(data) not in (None, r.page_id) else None
        want.append((r.page_id or 0, "revisit" if refers else "response", len(data),
                     hashlib.sha1(data).hexdigest(), refers, None))
    assert got == sorted(want, key=repr)


def test_broken_segments_are_reported(spark, pages):
    folder = work_folder(spark, "test-warc")
    warc.write_archives(pages.where("page_id = 7"), folder, segment=500)
    files = spark.read.format("binaryFile").load(folder).where("length > 0")
    records = bytes(files.first().content)
    parts = list(warc.parse(records))
    starts = [0, *(end + 4 for _, _, end in parts)]
    cut = records[: starts[1]] + records[starts[2] :]
    for name, content, problem in (
        ("missing", cut, "segments are missing"),
        ("short", records[: starts[-2]], "segments of another total length"),
        ("zipped", gzip.compress(records), None),
    ):
        bad = work_folder(spark, name)
        os.makedirs(bad)
        with open(f"{bad}/part.warc", "wb") as file:
            file.write(content)
        assert [r.problem for r in warc.read_archives(spark, bad).collect()] == [problem]


def test_empty_table(spark, pages):
    folder = work_folder(spark, "test-warc")
    warc.write_archives(pages.where("false"), folder)
    assert warc.read_archives(spark, folder).count() == 0
