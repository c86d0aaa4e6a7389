import glob
import gzip
import hashlib

import pytest

from barloom.llm import warc
from barloom.shared import new_path

SCHEMA = "page_id long, url string, html string, row string, member string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


BIG = "<p>über\r\n\r\nWARC/1.1</p>" * 20
ROWS = [
    (7, "http://a/7", BIG), (3, "http://a/3", BIG), (9, "http://a/9", BIG), (4, "http://a/4", "short"),
    (5, "http://a/5", "short"), (1, None, None), (2, "http://a/2\r\nX: y", ""),
    (8, "http://a/8", "".join(chr(33 + (i * i) % 90) for i in range(400_000))),
    (6, "http://a/6", "x" * 99), (10, "http://a/10", "x" * 99), (11, "http://a/11", "é" * 50),
    (12, "http://a/12", "é" * 50), (None, "http://a/n", BIG), (None, None, None), (5, "http://a/5", "short"),
]


def files(folder):
    return {p.rpartition("/")[2]: open(p, "rb").read() for p in glob.glob(f"{folder}/*.warc.gz")}


def test_round_trip(spark):
    folder = new_path(spark, "warc")
    manifest = warc.write(pages(spark, ROWS), folder, roll_bytes=2000)
    assert manifest.count() > 1
    assert {m.name for m in manifest.collect()} == set(files(folder))
    assert not glob.glob(f"{folder}/*.tmp") and not glob.glob(f"{folder}/.*.tmp")
    found = warc.read(spark, folder).collect()
    assert len(found) == len(ROWS)
    html = sorted((str(r[0]), (r[2] or "").encode()) for r in ROWS)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in found) == sorted(
        (page, len(h), hashlib.sha256(h).hexdigest()) for page, h in html
    )
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in found if r.page_id is not None}
    revisits = {p: r for p, (k, r) in kinds.items() if k == "revisit"}
    assert revisits == {7: 3, 9: 3, 12: 11}
    assert [(r.record_type, r.refers_to) for r in found if r.url == "http://a/n"] == [("revisit", 3)]
    by_id = {r.page_id: r for r in found if r.record_type == "response"}
    assert bytes(by_id[3].payload) == BIG.encode() and bytes(by_id[1].payload) == b""
    assert by_id[2].url == "http://a/2%0D%0AX: y" and by_id[1].url is None


def test_same_pages_same_bytes(spark):
    one, two = new_path(spark, "warc"), new_path(spark, "warc")
    warc.write(pages(spark, ROWS), one, roll_bytes=1500)
    warc.write(pages(spark, ROWS[::-1]).repartition(5), two, roll_bytes=1500)
    assert files(one) == files(two)


def test_files_are_readable_by_gzip(spark):
    folder = new_path(spark, "warc")
    warc.write(pages(spark, ROWS), folder)
    data = gzip.decompress(next(iter(files(folder).values())))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"\r\n\r\n")


def test_damage_is_an_error(spark):
    folder = new_path(spark, "warc")
    warc.write(pages(spark, ROWS), folder)
    path = glob.glob(f"{folder}/*.warc.gz")[0]
    with open(path, "ab") as out:
        out.write(b"more")
    with pytest.raises(Exception, match="manifest|header"):
        warc.read(spark, folder).collect()


def test_a_task_per_file_and_no_temporary_files(spark, monkeypatch):
    folder, fewer = new_path(spark, "warc"), new_path(spark, "warc")
    import os

    os.makedirs(folder.removeprefix("file:"), exist_ok=True)
    open(f"{folder.removeprefix('file:')}/.part-00000000.warc.gz-dead.tmp", "w").close()
    warc.write(pages(spark, ROWS), folder, roll_bytes=1500)
    assert not [p for p in os.listdir(folder.removeprefix("file:")) if p.endswith(".tmp")]
    monkeypatch.setattr(warc, "TASKS", 2)
    warc.write(pages(spark, ROWS), fewer, roll_bytes=1500)
    assert files(folder) == files(fewer) and len(files(folder)) > 2


def test_names_of_stores():
    assert warc.store_uri("file:/tmp/x") == warc.store_uri("file:///tmp/x") == "/tmp/x"
    assert warc.store_uri("/tmp/x") == "/tmp/x"
    assert warc.store_uri("s3a://bucket/x") == "s3://bucket/x"
    assert warc.store_uri("dbfs:/mnt/x") == "/dbfs/mnt/x"
    assert warc.store_uri("hdfs://host:8020/x") == "hdfs://host:8020/x"


def test_nothing(spark):
    folder = new_path(spark, "warc")
    assert warc.write(pages(spark, []), folder).count() == 0
    assert warc.read(spark, folder).count() == 0
