"""WARC archives of pages, and their index merged from sorted runs.

Writing: pages with a payload seen before become revisit records that name the
response with the smallest page_id. Each task writes its records sorted by URL
key, capture time and id, so each archive is a locally sorted capture run. The
files hold plain WARC/1.1 records.

Reading back: archives are parsed by Content-Length, the digest of every stored
payload is computed again and compared. The index entries (no payloads) are dealt
out by ranges of (URL key, time, id); every task then holds a slice of each run
and merges the slices with a loser tree into globally ordered capture histories.

Defined cases: null html is an empty payload; null url has an empty key; null
page_id is written as such and read back as null, and such a record is a response
only if no id has its payload; rows that repeat the smallest page_id are all
responses; ids of any size and sign have a capture time, and the id breaks ties; an empty table gives an empty result; only page_id, url and html are
read. A task parses one archive at a time; `records` bounds the records in one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.text import table
from tallymart.session import checkpoint_folder, cut_lineage

RECORDS = 10_000
EPOCH = 1_704_067_200  # first capture; a page's id counts seconds from here
SPAN = 3_000_000_000  # and begins anew after as many, so that every year has four digits
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ENTRY = ("archive string, at long, page_id long, url_key string, captured_at string, "
         "payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean")
ENTRY_ARROW = pa.schema([(name, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[kind])
                         for name, kind in (c.split() for c in ENTRY.split(", "))])


def base32(hexes: Column) -> Column:
    """Upper-case base32 of 40 hex digits: 5 hex digits are 4 base32 digits."""
    digits = []
    for k in range(8):
        bits = F.conv(F.substring(hexes, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            digits.append(F.substring(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*digits)


def url_key(url: Column) -> Column:
    """Host parts reversed, then the path: neighbours on a site are neighbours in the index."""
    plain = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z]+://(www\.)?|[\r\n]+", "")
    host = F.regexp_extract(plain, r"^([^/]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                    F.substr(plain, F.length(host) + 1))


def _records(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(key, time, id, record) with the whole text of each record."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.octet_length(html).cast("long").alias("bytes"), F.sha1(html.cast("binary")).alias("sha"))
    # Only payloads that occur more than once; written, so that the join below may split a hot one.
    firsts = cut_lineage(
        rows.select("sha", "page_id", "bytes").where(F.col("bytes") >= min_bytes).groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(
            F.col("sha").alias("same"), "first"))
    rows = rows.join(firsts, F.col("sha") == F.col("same"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    when = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(SPAN))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(line + line))
    head = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit(f"{line}WARC-Record-ID: <urn:page:"), name, F.lit(f">{line}WARC-Date: "), when,
        F.lit(f"{line}WARC-Target-URI: "),
        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]+", ""),
        F.lit(f"{line}WARC-Payload-Digest: sha1:"), base32(F.col("sha")),
        F.when(again, F.concat(
            F.lit(f"{line}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  f"{line}WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">")))
        .otherwise(""),
        F.lit(f"{line}Content-Type: application/http; msgtype=response{line}Content-Length: "),
        (F.octet_length(http) + F.when(again, 0).otherwise(F.col("bytes"))).cast("string"),
        F.lit(line + line))
    return rows.select(
        url_key(F.col("url")).alias("key"), when.alias("time"), "page_id",
        F.concat(head, http, F.when(again, "").otherwise(F.col("html"))).alias("record"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, records: int = RECORDS) -> None:
    """Writes `pages` as WARC files, one sorted capture run each, to a shared folder."""
    runs = _records(pages, min_bytes).sortWithinPartitions("key", "time", "page_id").select("record")
    runs.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records).text(folder)


_FIELD = re.compile(rb"([A-Za-z-]+): ?([^\r]*)\r\n")


def parse(archive: bytes) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
    """(position, header fields, block) of every record of one archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at) + 4
        fields = dict(_FIELD.findall(archive, at, end - 2))
        size = int(fields[b"Content-Length"])
        if not archive.startswith(b"WARC/1.1\r\n", at) or archive[end + size:end + size + 4] != b"\r\n\r\n":
            raise ValueError(f"no whole record at byte {at}")
        yield at, fields, archive[end:end + size]
        at = end + size + 4


def _page(urn: bytes | None) -> int | None:
    name = urn[len(b"<urn:page:"):-1] if urn else b"none"
    return None if name == b"none" else int(name)


def _entries(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in files:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            rows = []
            for at, fields, block in parse(content.as_py()):
                http = block.index(b"\r\n\r\n") + 4
                size = int(dict(_FIELD.findall(block, 0, http - 2))[b"Content-Length"])
                digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
                kind = fields[b"WARC-Type"].decode()
                body = block[http:]
                intact = not body if kind == "revisit" else (
                    len(body) == size and base64.b32encode(hashlib.sha1(body).digest()).decode() == digest)
                rows.append((path, at, _page(fields[b"WARC-Record-ID"]), fields[b"WARC-Target-URI"].decode(),
                             fields[b"WARC-Date"].decode(), size, digest, kind,
                             _page(fields.get(b"WARC-Refers-To")), intact))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ENTRY_ARROW, strict=True)],
                    schema=ENTRY_ARROW)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One index entry per record of the archives in `folder`."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    entries = files.mapInArrow(_entries, ENTRY)
    return entries.withColumn("url_key", url_key(F.col("url_key")))


def loser_tree(runs: list[Iterator]) -> Iterator:
    """Merges sorted runs of (key, ...) rows; each step replays one path of the tree."""
    done = (1,)  # sorts behind every live head, which is (0, row)
    heads = [next(((0, row) for row in run), done) for run in runs]
    k = len(runs)
    if not k:
        return
    losers = [-1] * k
    for leaf in range(k):
        winner, node = leaf, (leaf + k) >> 1
        while node and losers[node] >= 0:
            if heads[losers[node]] < heads[winner]:
                winner, losers[node] = losers[node], winner
            node >>= 1
        losers[node] = winner
    while heads[losers[0]] is not done:
        leaf = losers[0]
        yield heads[leaf][1]
        heads[leaf] = next(((0, row) for row in runs[leaf]), done)
        winner, node = leaf, (leaf + k) >> 1
        while node:
            if heads[losers[node]] < heads[winner]:
                winner, losers[node] = losers[node], winner
            node >>= 1
        losers[0] = winner


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the run slices of one range; only index entries are held."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).sort_by([("archive", "ascending"), ("at", "ascending")])
    # A null id is smaller than any other.
    keys = [(key.encode(), time, page is not None, page or 0, row) for row, (key, time, page) in enumerate(zip(
        *(rows.column(c).to_pylist() for c in ("url_key", "captured_at", "page_id")), strict=True))]
    runs = [list(own) for _, own in groupby(range(len(keys)), rows.column("archive").to_pylist().__getitem__)]
    order = [key[-1] for key in loser_tree([iter([keys[i] for i in run]) for run in runs])]
    first = TaskContext.get().partitionId() << 33
    out = rows.take(order).append_column("history_order", pa.array(range(first, first + len(order)), pa.int64()))
    yield from out.to_batches()


def merge_runs(entries: DataFrame) -> DataFrame:
    """Capture histories: entries in the order of (url_key, captured_at, page_id).

    `history_order` grows along that order over all tasks.
    """
    columns = "archive string, at long, page_id long, url_key string, captured_at string, " \
        "payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"
    written = cut_lineage(entries)
    return written.repartitionByRange("url_key", "captured_at", F.col("page_id"), "archive", "at").mapInArrow(
        _merge, f"{columns}, history_order long")


def op7_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    folder = f"{checkpoint_folder(spark)}/archives/{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), folder)
    return merge_runs(read_archives(spark, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key",
        "captured_at", "intact")


ORACLE = """
SELECT page_id, strlen(p) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to, url_key,
       strftime(to_timestamp(1704067200 + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured_at,
       true AS intact
FROM (
  SELECT page_id, p, min(page_id) OVER (PARTITION BY p) AS f,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(s, 5 * (i // 4) + 1, 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)), '') AS digest,
    array_to_string(list_reverse(string_split(regexp_extract(u, '^([^/]*)', 1), '.')), ',') || ')' ||
      regexp_replace(u, '^[^/]*', '') AS url_key
  FROM (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS s,
          regexp_replace(lower(coalesce(url, '')), '^[a-z]+://(www\\.)?', '') AS u FROM pages))
"""
