"""Archives: ARC and WARC files written, converted and read back, against brute force and an independent reader."""
import base64
import collections
import gzip
import hashlib
import io

import pytest

from helixframe.llm import warc
from helixframe.runtime import scratch_path

PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "http://a/ü x", "other é"), (4, None, None), (5, "http://a/5", ""),
         (6, "http://a/6", ""), (6, "http://a/6", ""), (None, "http://a/7", "same"), (None, None, "alone"), (8, "http://a/8", "x" * 300_000),
         (9, "http://a/9", "HTTP/1.1 200 OK\r\n\r\ninside\r\n\r\n"), (10, "http://a/10", "same")]


def expected(pages, least=0):
    payloads = [(i, (h or "").encode()) for i, _, h in pages]
    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    best = {}
    for k, (i, b) in enumerate(payloads):
        if len(b) >= least:
            best[b] = max(best.get(b, (-2, -1)), (-1 if i is None else i, k))
    rows = []
    for k, (i, b) in enumerate(payloads):
        first = len(b) < least or best[b][1] == k
        to = None if first else payloads[best[b][1]][0]
        rows.append((i, len(b), digest(b), "response" if first else "revisit", to))
    return collections.Counter(rows)


def shared_folder(spark):
    folder = scratch_path(spark, "archives")
    return folder if ":" in folder.split("/")[0] else "file://" + folder


@pytest.mark.parametrize("files", [1, 3])
@pytest.mark.parametrize("least", [0, 4, 5])
def test_pages_come_back(spark, files, least):
    pages = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id long, url string, html string, digest string").repartition(files)
    found = warc.archive_pages(spark, pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert collections.Counter(map(tuple, found)) == expected(PAGES, least)


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(spark, empty).count() == 0


def members(path):
    return gzip.decompress(open(path.removeprefix("file://"), "rb").read())


def test_warc_files_by_another_reader(spark):
    folder = shared_folder(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    arc = warc.write_arc(pages, f"{folder}/arc", bound=1 << 12)
    versions = set()
    for r in arc.collect():
        head, _, rest = members(r["path"]).partition(b"\n")
        versions.add(len(head.split(b" ")))
        assert head.startswith(b"filedesc://")
    assert versions == {5, 10}
    records = {}
    for r in warc.convert_arc(arc, f"{folder}/warc", bound=1 << 12).collect():
        data, at = members(r["path"]), 0
        while at < len(data):
            cut = data.index(b"\r\n\r\n", at)
            lines = data[at:cut].decode().split("\r\n")
            assert lines[0] == "WARC/1.0"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            size = int(fields["Content-Length"])
            block = data[cut + 4:cut + 4 + size]
            assert data[cut + 4 + size:cut + 8 + size] == b"\r\n\r\n"
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            records[fields["WARC-Record-ID"]] = (fields, block)
            at = cut + 8 + size
    kinds = collections.Counter(f["WARC-Type"] for f, _ in records.values())
    assert kinds["response"] == 6 and kinds["revisit"] == 6 and kinds["warcinfo"] >= 1
    for fields, block in records.values():
        if fields["WARC-Type"] == "revisit":
            to, body = records[fields["WARC-Refers-To"]]
            assert to["WARC-Type"] == "response" and to["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
            assert to["WARC-Target-URI"] == fields["WARC-Refers-To-Target-URI"] and to["WARC-Date"] == fields["WARC-Refers-To-Date"]
        if fields["WARC-Type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_dangling_reference_is_an_error(spark):
    folder = shared_folder(spark)
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "a")], "page_id long, url string, html string")
    one = warc.convert_arc(warc.write_arc(pages.coalesce(1), f"{folder}/arc"), f"{folder}/warc").first()["path"]
    kept = []
    data = members(one)
    for record in data.split(b"WARC/1.0\r\n")[1:]:
        if not record.startswith(b"WARC-Type: response"):
            kept.append(gzip.compress(b"WARC/1.0\r\n" + record))
    cut = one.removeprefix("file://").replace("part-", "cut-")
    open(cut, "wb").write(b"".join(kept))
    manifest = spark.createDataFrame([("file://" + cut, 1)], warc.MANIFEST)
    with pytest.raises(Exception, match="no record"):
        warc.scan_warc(manifest).collect()


def arc_file(version, *records):
    out = warc.arc_version_block(version, "x.arc", "20010203040506")
    return out + b"".join(records)


def test_foreign_and_cut_files():
    one = arc_file(1, b"http://a/ 1.2.3.4 20010203040506 text/plain 5\nhello\n", b"\n", b"http://b/ 1.2.3.4 2001 text/plain 0\n\n")
    found = list(warc.read_arc(io.BytesIO(one), "x"))
    assert [(h["URL"], h["Archive-date"], b) for _, h, b in found] == [("http://a/", "20010203040506", b"hello"), ("http://b/", "2001", b"")]
    two = arc_file(2, b"http://a/ 1.2.3.4 20010203040506 text/plain 404 abc http://to/ 77 x.arc 2\nhi\n")
    (_, head, body), = warc.read_arc(io.BytesIO(two), "x")
    assert (head["Result-code"], head["Checksum"], head["Location"], body) == ("404", "abc", "http://to/", b"hi")
    assert warc.warc_date("2001") == "2001-01-01T00:00:00Z" and warc.warc_date("20011231235958") == "2001-12-31T23:59:58Z"
    for wrong in (b"no header\n", b"http://a/ 1.2.3.4 2001 text/plain x\n", b"http://a/ 1.2.3.4 2001 text/plain 50\nshort\n"):
        with pytest.raises(ValueError, match="x"):
            list(warc.read_arc(io.BytesIO(arc_file(1, wrong)), "x"))
