import gzip
import random

import pyarrow.fs as pafs
import pytest
from stardw.llm import warc
from stardw.session import work_folder

BIG = "<p>" + "x" * 1000


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS key", "'a' AS digest")
    return make


ROWS = [
    (1, "u1", BIG), (2, "u2", BIG), (3, None, BIG), (4, "u\r\n4%", "é"), (5, "u5", "é"), (6, "u6", None), (7, "u7", ""),
    (3, "again", BIG), (None, "none", BIG), (8, "u8", "long " * 200_000), (9, "u9", "WARC/1.1\r\n\r\n\x1f"),
]


def test_round_trip(spark, pages):
    for size in (64, 1000, 1 << 24):
        found = warc.round_trip(pages(ROWS), work_folder(spark, "test-warc"), size).collect()
        assert len(found) == len(ROWS)
        got = sorted(((r.record_id, r.uri, r.type, r.refers_to, r.length) for r in found), key=repr)
        want = []
        for key, url, html in ROWS:
            last = 3 if html == BIG and key != 3 else None
            want.append((None if key is None else str(key), url, "revisit" if last else "response",
                         None if last is None else str(last), len((html or "").encode())))
        assert got == sorted(want, key=repr)
        for r in found:
            if r.type == "response" and r.record_id not in (None, "3"):
                assert r.payload.decode() == (next(h for k, _, h in ROWS if str(k) == r.record_id) or "")


def test_bytes_that_only_look_like_a_member(tmp_path):
    rng = random.Random(1)
    noise = bytes(rng.randrange(256) for _ in range(300))
    false = gzip.compress(b"no record " + noise, 0)
    true = warc.encoded(5, "u", b"page", "00" * 20, None)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(warc.MAGIC + noise + true + warc.MAGIC * 3 + false + true)
    with pafs.LocalFileSystem().open_input_file(str(path)) as file:
        size = path.stat().st_size
        whole = [at for at, _, _ in warc.records(file, 0, size)]
        assert len(whole) == 2
        parts = [at for low in range(0, size, 7) for at, _, _ in warc.records(file, low, min(low + 7, size))]
        assert parts == whole


def test_damaged_member_is_an_error(spark, tmp_path):
    path = tmp_path / "b.warc.gz"
    path.write_bytes(warc.encoded(1, "u", b"x" * 5000, "00" * 20, None)[:-20])
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")
    with pytest.raises(Exception, match="damaged record"):
        warc.read(files).collect()


def test_member_with_several_records(spark, tmp_path):
    path = tmp_path / "c.warc.gz"
    parts = [gzip.decompress(warc.encoded(i, "u", b"x" * i, "00" * 20, None)) for i in (1, 2, 3)]
    path.write_bytes(gzip.compress(b"".join(parts)) + gzip.compress(parts[0]))
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")
    assert sorted(r.length for r in warc.read(files).collect()) == [1, 1, 2, 3]


def test_empty_table(spark, pages):
    assert warc.round_trip(pages([]), work_folder(spark, "test-warc")).count() == 0
