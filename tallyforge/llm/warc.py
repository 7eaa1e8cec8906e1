"""Web pages into WARC archives, and selected records back out of them, by an index.

Writing: one record a page, ended as the format asks, by Spark's text writer, so that archives
appear only when their task has committed and a task that runs again leaves nothing twice. Pages of
equal payload are stored once: the one with the largest id is the response, the others are revisit
records that refer to it.

Reading is index first. A pass over the archives reads the records' headers and writes offset,
length, URL and digest of each record; ``read`` then takes any selection of index rows, sorts it by
archive and offset, joins ranges that lie close together and reads each range once. Selections are
dealt out by ranges of (archive, offset), so neither an archive nor a record kind is one task's.

Edge cases: a null html is an empty payload, and empty payloads are equal like any others. Repeated rows,
also rows of one id, are records of their own; of those of equal payload and the largest id one is the
response. A null id counts as smaller than all others and comes back as null. A null URL is left out of
the record and comes back as null; control characters and blanks in a URL are percent-encoded.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fixed: what a record begins and ends with, and the profile of a revisit.
VERSION, END = "WARC/1.1", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed: digits of base 32, after those that ``conv`` gives.
CONV, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Bytes read at once for headers; bytes between two records that are read too rather than sought over;
#: bytes of a joined range, and of a reading task, about.
WINDOW, GAP, RANGE, TASK = 1 << 18, 1 << 16, 8 << 20, 32 << 20
INDEX = "archive string, offset long, length long, url string, digest string, kind string, record string, refers string, page_id long"


def base32(sha1: Column) -> Column:
    """The 40 hex digits of a SHA-1 in base 32: five of them are four digits."""
    parts = [F.lpad(F.conv(F.substring(sha1, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), CONV, BASE32)


def _url(url: Column) -> Column:
    each = F.transform(F.split(url, ""), lambda c: F.when(c.rlike(r"[\x00-\x20\x7F]"), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0"))).otherwise(c))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), F.array_join(each, "")).otherwise(url)


def _field(name: str, value: Column) -> Column:
    """A header line; none where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, date: str) -> DataFrame:
    """(value) the records of pages (page_id, url, html), without their ends."""
    rows = common.identified(common.pick(pages, "page_id", "url", "html"), "at")
    payload = F.coalesce("html", F.lit(""))
    rows = rows.withColumn("same", F.sha2(payload.cast("binary"), 256))
    # Equal payloads are known by a stronger digest than the one that the records carry.
    groups = rows.groupBy("same").agg(F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "at")).alias("first"), F.count("*").alias("n"))
    groups = common.stored(groups.where("n > 1").select("same", F.col("first.at").alias("first")), "groups")
    rows = rows.join(common.small_or_shuffled(groups), "same", "left")
    # A name for each row that is the same whenever its task runs again.
    named = lambda at: F.concat(F.lit("<urn:sha256:"), F.sha2(at, 256), F.lit(">"))
    again = F.col("first").isNotNull() & (F.col("at") != F.col("first"))
    size = F.octet_length(payload).cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    block = F.when(again, F.lit("")).otherwise(F.concat(http, payload))
    head = F.concat(
        F.lit(VERSION + "\r\n"),
        _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _field("WARC-Record-ID", named(F.col("at"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _url(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.sha1(payload.cast("binary"))))),
        _field("WARC-Refers-To", F.when(again, named(F.col("first")))),
        _field("WARC-Profile", F.when(again, F.lit(PROFILE))),
        _field("Page-Id", F.col("page_id").cast("string")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(head, F.lit("\r\n"), block).alias("value"))


def write(pages: DataFrame, path: str, date: str | None = None) -> None:
    """Archives of pages (page_id, url, html) in a new folder, one for each task. date: of the records, by default now."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    with common.scratch(pages.sparkSession):
        records(pages, date).write.option("lineSep", END).text(path)


def _file(archive: str):
    """An archive of any store that pyarrow knows, open for reading at any place."""
    from pyarrow import fs

    if archive.startswith("file:"):  # Spark writes file:/path
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", archive))
    store, path = fs.FileSystem.from_uri(archive)
    return store.open_input_file(path)


def _fields(head: bytes) -> dict[str, str]:
    """The named fields of a header, their names in lower case."""
    lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record begins with {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def headers(archive: str, size: int) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(offset, length, fields) of each record, reading no payload that lies beyond the window."""
    with _file(archive) as f:
        at, begin, window = 0, 0, b""
        while at < size:
            end, want = -1, WINDOW
            while end < 0:
                if begin <= at and (end := window.find(b"\r\n\r\n", at - begin)) >= 0:
                    break
                if begin == at and begin + len(window) >= size:
                    raise ValueError(f"{archive}: a record without an end at {at}")
                f.seek(at)
                begin, window = at, f.read(min(want, size - at))
                want *= 2
            fields = _fields(window[at - begin : end])
            length = begin + end + 4 - at + int(fields["content-length"])
            yield at, length, fields
            at += length + len(END)


def index(spark: SparkSession, path: str) -> DataFrame:
    """(archive, offset, length, url, digest, kind, record, refers, page_id) of all records below a folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        for files in batches:
            for archive, size in zip(files["path"], files["length"], strict=True):
                rows: list[tuple] = []
                for offset, length, fields in headers(archive, size):
                    page = fields.get("page-id")
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append((archive, offset, length, fields.get("warc-target-uri"), digest, fields["warc-type"], fields["warc-record-id"], fields.get("warc-refers-to"), int(page) if page else None))
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})
                        rows = []
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "offset": "int64", "length": "int64"})

    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    return files.mapInPandas(run, INDEX)


def ranges(rows: pd.DataFrame) -> Iterator[tuple[str, int, int, list[int]]]:
    """(archive, begin, end, positions of its rows) of rows sorted by archive and offset.

    Records closer than GAP are one range, up to RANGE bytes; a longer record is a range of its own.
    """
    archive, begin, end, own = "", 0, 0, []
    for i, (a, offset, length) in enumerate(zip(rows["archive"], rows["offset"].tolist(), rows["length"].tolist(), strict=True)):
        if own and (a != archive or offset - end > GAP or max(end, offset + length) - begin > RANGE):
            yield archive, begin, end, own
            own = []
        if not own:
            archive, begin, end = a, offset, offset
        own.append(i)
        end = max(end, offset + length)
    if own:
        yield archive, begin, end, own


def read(selected: DataFrame) -> DataFrame:
    """Index rows with ``payload``, the bytes after the HTTP header; empty for records that hold none.

    selected: any rows of a stored ``index``, all of its columns.
    """
    names = [c.split()[0] for c in INDEX.split(", ")]
    total = selected.agg(F.sum("length")).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for archive, begin, end, own in ranges(rows):
                with _file(archive) as f:
                    f.seek(begin)
                    data = memoryview(f.read(end - begin))
                part = rows.iloc[own]
                payloads = []
                for offset, length in zip(part["offset"], part["length"], strict=True):
                    record = bytes(data[offset - begin : offset - begin + length])
                    body = record.find(b"\r\n\r\n") + 4
                    http = record.find(b"\r\n\r\n", body)
                    payloads.append(record[http + 4 :] if http >= 0 else b"")
                yield part.assign(payload=payloads)

    # Ranges of (archive, offset), so many that a task reads about TASK bytes.
    dealt = selected.select(*names).repartitionByRange(int(max(1, -(-total // TASK))), "archive", "offset").sortWithinPartitions("archive", "offset")
    # page_id goes as text: pandas would turn whole numbers beside nulls into floats.
    plain = dealt.withColumn("page_id", F.col("page_id").cast("string"))
    out = plain.mapInPandas(run, INDEX.replace("page_id long", "page_id string") + ", payload binary")
    return out.withColumn("page_id", F.col("page_id").cast("long"))


def digested(found: DataFrame) -> DataFrame:
    """Records (.., payload) with payload_bytes and payload_digest, as read, in place of the payload."""
    read_digest = base32(F.sha1("payload")).alias("payload_digest")
    return found.select("page_id", "kind", "record", "refers", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), read_digest)


def resolved(rows: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all ``digested`` records, stored.

    A revisit has its response's bytes and digest. A digest that differs from the one in the header, and a
    revisit whose response is not there, are errors.
    """
    answers, revisits = rows.where("kind = 'response'"), rows.where("kind = 'revisit'")
    wrong = F.raise_error(F.concat(F.lit("wrong payload, or none, for "), F.coalesce("refers", "record"))).cast("string")
    digest = F.when(F.col("payload_digest") == F.col("digest"), F.col("payload_digest")).otherwise(wrong).alias("payload_digest")
    one = answers.select("page_id", "payload_bytes", digest, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    # Only responses that something refers to meet the revisits.
    asked = common.small_or_shuffled(revisits.select(F.col("refers").alias("record")).distinct())
    known = answers.join(asked, "record", "left_semi").select(F.col("record").alias("refers"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    other = revisits.select("page_id", "refers", "digest", "record").join(common.small_or_shuffled(known), "refers", "left")
    return one.unionByName(other.select("page_id", "payload_bytes", digest, F.lit("revisit").alias("record_type"), "refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives, indexed, and read back through the index; the archives go afterwards."""
    spark = pages.sparkSession
    path = f"{common.shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    try:
        with common.scratch(spark) as kept:
            write(pages, path)
            rows = kept(digested(read(common.stored(index(spark, path), "index"))), "records")
    finally:
        common.deleted(spark, [path])
    return resolved(rows)
