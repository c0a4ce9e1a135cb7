import gzip
import hashlib
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F

from tableferry.llm import warc
from tableferry.session import new_folder

LONG = "<p>" + "é" * 300_000
PAGES = [
    (1, "http://a/1", "x" * 100),
    (2, "http://a/2 b\r\nc", "x" * 100),
    (3, None, "x" * 99),
    (4, "http://a/4", "x" * 99),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (7, "http://a/7", LONG),
    (8, "http://a/8", LONG),
    (8, "http://a/8", LONG),
    (None, "http://a/9", "y" * 200),
    (None, "http://a/10", "y" * 200),
    (9, "http://a/11", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5),
    (7, "http://a/7", LONG),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    return rows.withColumns({n: F.lit("x") for n in ("payload_digest", "owner", "record_type", "value", "n")})


def expected():
    out = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        equal = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        owner = min(equal) if equal and len(data) >= 100 else None
        revisit = owner is not None and page != owner
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", owner if revisit else None))
    return sorted(out, key=str)


def test_read_back(pages):
    rows = warc.archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in rows.collect()), key=str) == expected()


def test_members_and_index(spark, pages):
    folder = new_folder(spark, "warc-test")
    warc.write_monolithic(warc.marked(pages), f"{folder}/one", records_per_file=4)
    assert warc.normalise(spark, f"{folder}/one", f"{folder}/two") == len(PAGES)
    index = warc.index_of(spark, f"{folder}/two").collect()
    assert len(index) == len(PAGES)
    for entry in index:
        with open(entry["archive"].removeprefix("file://"), "rb") as file:
            file.seek(entry["offset"])
            record = zlib.decompress(file.read(entry["length"]), 31)  # one whole member
        headers, whole = next(warc.parsed([record]))
        assert whole == record and headers["warc-type"] == entry["type"]
    names = os.listdir(f"{folder}/two")
    assert all(n.endswith((".warc.gz", ".cdxj")) or n.startswith(".") for n in names)
    # The members of an archive, one after the other, are the stream it was made from.
    for name in (n for n in names if n.endswith(".warc.gz") and not n.startswith(".")):
        source = name.replace(".warc.gz", ".txt.gz")
        with gzip.open(f"{folder}/one/{source}") as a, gzip.open(f"{folder}/two/{name}") as b:
            assert a.read() == b.read()


def test_a_repeated_task_finds_its_work_done(spark, pages):
    folder = new_folder(spark, "warc-again")
    warc.write_monolithic(warc.marked(pages), f"{folder}/one")
    streams = [f"{folder}/one/{n}" for n in os.listdir(f"{folder}/one") if n.endswith(".gz")]
    os.makedirs(f"{folder}/two")
    for stream in streams:
        n = warc.rewrite(stream, f"{folder}/two/{os.path.basename(stream)}", remove=True)
        assert not os.path.exists(stream)
        assert warc.rewrite(stream, f"{folder}/two/{os.path.basename(stream)}", remove=True) == n


def test_inflate_takes_any_number_of_members():
    data = os.urandom(3_000_000)
    packed = b"".join(gzip.compress(data[i : i + 700_000]) for i in range(0, len(data), 700_000))
    assert b"".join(warc.inflated(io.BytesIO(packed))) == data


def test_cut_off_archives_are_refused():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc"
    with pytest.raises(ValueError):
        list(warc.parsed([record]))
    with pytest.raises(ValueError):
        list(warc.parsed([b"WARC/1.1\r\nContent-Le"]))


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(none).count() == 0
