"""Legacy archive converter: ARC files to WARC files, with repeated payloads as revisit records.

ARC files start with a version block that says which columns their header lines have (version 1: five, version 2:
ten); every record is a header line, a body of the declared length and a line end. The converter reads these
and makes the WARC identifiers, dates, types and digests ARC lacks. Executors read and write the archives as streams
in the shared folder through Arrow's file systems; manifests of the files that finished tasks wrote say which
files count, so that a repeated task leaves nothing double. File sizes are bounded, and only digests are shuffled.

Edge cases: a null payload is empty, a null address is written as ``unknown:``, a null page_id stays null; repeated rows
are records of their own (equal payload and page_id: the record that comes last in the archives is the response); an
empty table gives empty archives and no rows; other columns are ignored. A header line that does not fit its version
ends the reading of its file with an error that names file and place.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.runtime import salted_join, scratch_path, stage

#: Columns of the header lines of the two versions.
ARC_COLUMNS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
MANIFEST = "path string, records long"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(uri: str, mode: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    if mode == "w":
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        return fs.open_output_stream(path, compression=None)
    return io.BufferedReader(gzip.GzipFile(fileobj=fs.open_input_file(path)), 1 << 18)


class _Roll:
    """Writes gzip members to files of bounded size; ``closed`` lists (path, records) of the finished ones."""

    def __init__(self, folder: str, suffix: str, first, bound: int):
        task = TaskContext.get()
        self.stem = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        self.suffix, self.first, self.bound, self.closed, self.out = suffix, first, bound, [], None

    def add(self, make) -> None:
        """``make(name, offset)`` gives the bytes of a record; offsets count bytes before compression."""
        if self.out is None:
            self.path = f"{self.stem}-{len(self.closed):03d}.{self.suffix}"
            self.name, self.out, self.size, self.raw, self.records = self.path.rpartition("/")[2], _open(self.path, "w"), 0, 0, 0
            self._put(self.first(self.name))
        self._put(make(self.name, self.raw))
        self.records += 1
        if self.size >= self.bound:
            self.close()

    def _put(self, record: bytes) -> None:
        member = gzip.compress(record, 1, mtime=0)
        self.out.write(member)
        self.size += len(member)
        self.raw += len(record)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.closed.append((self.path, self.records))
            self.out = None


# ---- ARC

def arc_header(version: int, url: str, ip: str, date: str, mime: str, length: int, code: int, offset: int, name: str) -> bytes:
    values = {"URL": quote(url, safe="!#$%&'()*+,/:;=?@[]~") or "unknown:", "IP-address": ip, "Archive-date": date,
              "Content-type": mime, "Result-code": str(code), "Checksum": "-", "Location": "-", "Offset": str(offset),
              "Filename": name, "Archive-length": str(length)}
    return (" ".join(values[c] for c in ARC_COLUMNS[version]) + "\n").encode()


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 archive\n{' '.join(ARC_COLUMNS[version])}\n".encode()
    return arc_header(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(body), 200, 0, name) + body + b"\n"


def read_arc(stream, path: str) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, header by column, body) of every record after the version block."""
    columns, at = None, 0
    while True:
        line = stream.readline()
        if not line:
            return
        start, at = at, at + len(line)
        if line == b"\n":
            continue
        parts = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if columns is None and parts[0].startswith("filedesc://") and len(parts) in map(len, ARC_COLUMNS.values()):
            names = next(c for c in ARC_COLUMNS.values() if len(c) == len(parts))
        elif columns is not None and len(parts) == len(columns):
            names = columns
        else:
            raise ValueError(f"{path}, byte {start}: no header line of this version")
        head = dict(zip(names, parts))
        if not head["Archive-length"].isdigit():
            raise ValueError(f"{path}, byte {start}: length {head['Archive-length']!r}")
        body = stream.read(int(head["Archive-length"]))
        if len(body) != int(head["Archive-length"]):
            raise ValueError(f"{path}, byte {start}: record cut short")
        at += len(body)
        if columns is None:
            version = body[:1].decode("ascii", "replace")
            if not version.isdigit() or int(version) not in ARC_COLUMNS:
                raise ValueError(f"{path}: unknown version {version!r}")
            columns = ARC_COLUMNS[int(version)]
        else:
            yield start, head, body


def _http(body: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """HTTP fields in lower case, the head with its empty line, the payload."""
    cut = body.find(b"\r\n\r\n")
    if not body.startswith(b"HTTP/") or cut < 0:
        return {}, b"", body
    fields = dict(x.split(": ", 1) for x in body[:cut].decode("latin-1").split("\r\n")[1:] if ": " in x)
    return {k.lower(): v for k, v in fields.items()}, body[:cut + 4], body[cut + 4:]


def write_arc(pages: DataFrame, folder: str, date: str = "20260101000000", bound: int = 32 << 20) -> DataFrame:
    """Writes page_id, url, html as ARC files, odd parts in version 1 and even ones in version 2; gives the manifest."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        version = 2 - TaskContext.get().partitionId() % 2
        roll = _Roll(folder, "arc.gz", lambda name: arc_version_block(version, name, date), bound)
        for batch in batches:
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                payload = html.encode("utf-8", "replace")
                own = "" if page_id is None or pd.isna(page_id) else f"X-Page-Id: {int(page_id)}\r\n"
                body = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}"
                        f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
                roll.add(lambda name, offset: arc_header(version, url, "0.0.0.0", date, "text/html", len(body), 200, offset, name)
                         + body + b"\n")
        roll.close()
        yield pd.DataFrame(roll.closed, columns=["path", "records"])

    rows = pages.select(F.col("page_id").cast("long").cast("string").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    return stage(rows.mapInPandas(write, MANIFEST), "arc-manifest")


# ---- WARC

def warc_date(arc_date: str) -> str:
    """Parts that a short ARC date leaves out are the first of their kind."""
    d = arc_date + "00000101000000"[len(arc_date):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{digest_of(block)}"), ("Content-Length", str(len(block)))]
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def read_warc(stream, path: str) -> Iterator[tuple[dict, bytes]]:
    """Fields in lower case and block of every record."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: no WARC record")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            head[name.lower()] = value
        yield head, stream.read(int(head["content-length"]))


def record_id(path: str, offset: int, url: str, date: str) -> str:
    """The same for every attempt to convert the record."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{path.rpartition('/')[2]} {offset} {date} {url}").urn


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            rows = []
            with _open(path, "r") as stream:
                for offset, head, body in read_arc(stream, path):
                    fields, _, payload = _http(body)
                    date = warc_date(head["Archive-date"])
                    rows.append((path, offset, fields.get("x-page-id"), digest_of(payload), len(payload), head["URL"], date,
                                 record_id(path, offset, head["URL"], date)))
            yield pd.DataFrame(rows, columns=["path", "offset", "page_id", "digest", "bytes", "url", "date", "id"])


def _many(manifest: DataFrame) -> DataFrame:
    """One task for each file, as far as hashing spreads them."""
    return manifest.repartition(max(1, manifest.count()), "path")


def convert_arc(manifest: DataFrame, folder: str, min_bytes: int = 0, bound: int = 32 << 20) -> DataFrame:
    """Converts the ARC files of ``manifest`` to WARC files in ``folder``; gives their manifest.

    Of records with equal payloads of at least ``min_bytes`` the one with the largest page_id is the response, and the
    others refer to it; the choice is one aggregate by digest, which is combined before it is shuffled.
    """
    records = stage(_many(manifest).mapInPandas(_digests, "path string, offset long, page_id string, digest string, bytes long, "
                                                "url string, date string, id string")
                    .withColumn("page_id", F.col("page_id").cast("long")), "arc-records")
    shared = F.when(F.col("bytes") >= min_bytes, F.col("digest"))
    last = (records.where(shared.isNotNull()).groupBy("digest").agg(F.max(F.struct("page_id", "path", "offset", "url", "date", "id")).alias("r"),
                                                                    F.count("*").alias("records"))
            .where("records > 1").select(F.col("digest").alias("shared"), "r"))
    # one digest may be that of a third of all records (empty pages), so its rows are spread
    chosen = salted_join(records.select("path", "offset", "id", shared.alias("shared")), last, ["shared"], "left", ["path", "offset"])
    to = F.when(F.col("r.id") != F.col("id"), F.struct("r.id", "r.url", "r.date"))
    plan = chosen.select("path", F.struct("offset", "id", to.alias("to")).alias("d")) \
                 .groupBy("path").agg(F.collect_list("d").alias("todo"))  # as many as one archive file holds

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        info = lambda name: warc_record("warcinfo", [("WARC-Record-ID", record_id(name, 0, "", "")),
                                                     ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.0\r\n")
        roll = _Roll(folder, "warc.gz", info, bound)
        for batch in batches:
            for path, todo in zip(batch["path"], batch["todo"]):
                planned = {d["offset"]: (d["id"], d["to"]) for d in todo}
                with _open(path, "r") as stream:
                    for offset, head, body in read_arc(stream, path):
                        _, http, payload = _http(body)
                        own, to = planned[offset]
                        fields = [("WARC-Record-ID", f"<{own}>"), ("WARC-Target-URI", head["URL"]),
                                  ("WARC-Date", warc_date(head["Archive-date"])), ("WARC-IP-Address", head["IP-address"]),
                                  ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}")]
                        kind = "response" if http else "resource"
                        fields.append(("Content-Type", "application/http; msgtype=response" if http else head["Content-type"]))
                        block = body
                        if to is not None:
                            kind, block = "revisit", http
                            fields += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                                       ("WARC-Refers-To", f"<{to['id']}>"),
                                       ("WARC-Refers-To-Target-URI", to["url"]), ("WARC-Refers-To-Date", to["date"])]
                        roll.add(lambda name, at: warc_record(kind, fields, block))
        roll.close()
        yield pd.DataFrame(roll.closed, columns=["path", "records"])

    return stage(plan.repartition(max(1, manifest.count()), "path").mapInPandas(write, MANIFEST), "warc-manifest")


def _page_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            rows = []
            with _open(path, "r") as stream:
                for head, block in read_warc(stream, path):
                    if head["warc-type"] == "warcinfo":
                        continue
                    fields, _, payload = _http(block)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    revisit = head["warc-type"] == "revisit"
                    if not revisit and digest_of(payload) != digest:
                        raise ValueError(f"{path}: payload of {head['warc-record-id']} does not fit its digest")
                    size = int(fields.get("content-length", 0)) if revisit else len(payload)
                    rows.append((fields.get("x-page-id"), size, digest, head["warc-type"], head["warc-record-id"], head.get("warc-refers-to"),
                                 head["warc-target-uri"], head["warc-date"]))
            yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers", "url", "date"])


def scan_warc(manifest: DataFrame) -> DataFrame:
    """One row per record of the WARC files; refers_to is the page_id of the record a revisit refers to.

    A reference to a record that none of the files holds is an error.
    """
    rows = stage(_many(manifest).mapInPandas(_page_records, "page_id string, payload_bytes long, payload_digest string, record_type string, "
                                             "record_id string, refers string, url string, date string")
                 .withColumn("page_id", F.col("page_id").cast("long")), "warc-records")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "date"]
    answers, revisits = rows.where("refers is null"), rows.where("refers is not null")
    responses = rows.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"),
                                                              F.lit(True).alias("held"))
    named = revisits.select("refers").distinct().join(responses, "refers", "left").withColumn("refers_to", F.when(F.col("held"), F.col("refers_to")).otherwise(
        F.raise_error(F.concat(F.lit("no record "), "refers", F.lit(" in these archives"))).cast("long"))).drop("held")
    resolved = salted_join(revisits, named, ["refers"], "left", ["record_id"])
    return answers.withColumn("refers_to", F.lit(None).cast("long")).select(out).unionByName(resolved.select(out))


def archive_pages(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC files, those to WARC files, and the records read back from these."""
    folder = scratch_path(spark, "archives")
    if ":" not in folder.split("/")[0]:
        folder = "file://" + folder
    arc = write_arc(pages, f"{folder}/arc")
    return scan_warc(convert_arc(arc, f"{folder}/warc", min_bytes))
