"""Web archives and their merged capture index.

Pages are written as WARC/1.1 records through Spark's own text writer: a record is
text, and the blank lines that end it are the writer's line separator, so every
archive is committed like any other Spark output, on any file system. Reading goes by
``Content-Length``, so a payload may hold blank lines itself.

Every archive read back yields one run of index entries, sorted by URL key, time and
page. A key range of the whole index is one task, which merges the parts of all runs that fall into
it with a loser tree; ranges follow each other, so the index is globally ordered. The
cut points hold time and page as well, so the captures of one URL can spread over tasks.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfwise.llm.common import stored
from shelfwise.session import run_folder

END = "\r\n\r\n"
RECORDS = 4_000              # in an archive, at most
SMALL = 2**15                # payload bytes of which an archive holds RECORDS records; of twice as many half as many, and so on
RANGE_ROWS, RANGES = 500, 100_000  # index entries in a key range, about; most ranges
SAMPLES = 16                 # keys per range that the cut points come from, about
EPOCH = 1_704_067_200        # page n was captured n seconds (modulo a year) after 2024-01-01
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = ("urlkey string, time string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, "
         "refers_to bigint, archive string, offset bigint, length bigint")
NAMES = [part.split()[0] for part in ENTRY.split(", ")]
KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


@F.pandas_udf(T.StringType())  # a type given as text would need a session at import
def _base32(digest: pd.Series) -> pd.Series:
    return digest.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode())


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """``value``: one WARC record per row of ``pages`` (``page_id, url, html``), without the blank lines at its end.

    Of equal payloads of at least ``least`` bytes the one with the smallest page_id is the
    response, and the others are revisits that name it. A null html is an empty
    payload, a null url an empty one; line breaks in a URL are percent-encoded.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
    first = (rows.groupBy("digest").agg(F.min("page_id").alias("first"))
             .select(F.col("digest").alias("_digest"), "first"))
    rows = rows.join(first, F.col("digest") == F.col("_digest"))
    revisit = (F.col("bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    time = F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(31_536_000)))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")),
        F.lit("\r\nWARC-Date: "), F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), _base32("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT}\r\nWARC-Refers-To: "), name(F.col("first")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit(END), block).alias("value"))


def size_class(size: Column) -> Column:
    """0 up to ``SMALL`` bytes, and one more with each doubling."""
    times = F.floor((size - 1) / SMALL)
    return F.when(times <= 0, 0).otherwise(F.length(F.bin(times)))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> None:
    """A folder of compressed WARC files, each of at most ``RECORDS * SMALL`` payload bytes or of one record.

    Pages are written by size class, so that a number of records bounds a file's bytes. Equal payloads are of one
    class, so each class knows its own first ones. There are as many passes as classes that occur.
    """
    kind = size_class(F.octet_length(F.coalesce("html", F.lit(""))))
    classes = sorted(row[0] for row in pages.select(kind).distinct().collect()) or [0]
    for n, c in enumerate(classes):
        part = pages.where(kind == c) if len(classes) > 1 else pages
        (records(part, least).write.mode("append" if n else "error").option("lineSep", END).option("compression", "gzip")
         .option("maxRecordsPerFile", max(1, RECORDS >> c)).text(folder))


def url_key(url: str) -> str:
    """The URL in sortable form: host labels reversed, without scheme, user, ``www`` and fragment; lower case."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url.lower()
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return (",".join(reversed(host.split("."))) + port + ")" + rest).lower()


def read_records(data: bytes, archive: str) -> Iterator[tuple]:
    """The index entries of the records of one archive, in file order.

    The digest of every response is computed anew; one that differs from the header is an error.
    """
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8").split("\r\n")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start, size = head_end + 4, int(head["Content-Length"])
        block = data[start: start + size]
        http_end = block.index(b"\r\n\r\n")
        told = int(block[:http_end].rsplit(b"Content-Length: ", 1)[1])
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response":
            payload = block[http_end + 4:]
            if len(payload) != told or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"{archive}: the record at {at} is damaged")
        end = start + size + 4
        yield (url_key(head["WARC-Target-URI"]), head["WARC-Date"], _page(head["WARC-Record-ID"]), kind, told, digest,
               _page(head["WARC-Refers-To"]) if kind == "revisit" else None, archive, at, end - at)
        at = end


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def _order(entry: tuple) -> tuple:
    """URL key, time, page (null first), place of the record: a total order."""
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[7], entry[8]


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """The index entries of all archives of a folder, with ``place``: their order in their archive's run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = content.as_buffer().to_pybytes()
                if path.endswith(".gz"):
                    data = zlib.decompressobj(31).decompress(data)
                entries = sorted(read_records(data, path.rsplit("/", 1)[-1]), key=_order)
                if entries:
                    yield _table(entries, pa.array(range(len(entries)), pa.int64()), "place")

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(run, ENTRY + ", place bigint")


def _table(entries: list[tuple], more: pa.Array, name: str) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*entries), KINDS)]
    return pa.RecordBatch.from_arrays([*columns, more], names=[*NAMES, name])


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, lists: list[list[tuple]]):
        self.sources = [iter(x) for x in lists]
        self.n = len(lists)
        self.heads = [self._next(i) for i in range(self.n)]
        self.losers = [-1] * max(1, self.n)
        for i in range(self.n):
            self._play(i, building=True)

    def _next(self, i: int):
        entry = next(self.sources[i], None)
        return None if entry is None else (_order(entry), entry)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None
        return x[0] < y[0]

    def _play(self, i: int, building: bool = False) -> None:
        node = (i + self.n) // 2
        while node:
            other = self.losers[node]
            if other == -1:
                self.losers[node] = i
                if building:
                    return
            elif self._less(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.n:
            i = self.losers[0]
            if self.heads[i] is None:
                return
            yield self.heads[i][1]
            self.heads[i] = self._next(i)
            self._play(i)


def merged_index(entries: DataFrame) -> DataFrame:
    """All entries with ``range`` and ``place``: ordered by both, they are in the order of the index.

    ``entries`` are stored :func:`runs`. The only rows that reach the driver are cut points, about
    ``SAMPLES`` times ``RANGES`` at most.
    """
    n = entries.count()
    ranges = int(min(RANGES, max(1, n // RANGE_ROWS)))
    share = min(1.0, ranges * SAMPLES / max(n, 1))
    mark = F.pmod(F.xxhash64("archive", "place"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    order = ["urlkey", "time", "page_id", "archive", "offset"]
    found = entries.where(mark).select(*order).collect() if ranges > 1 else []
    keys = sorted((r[0], r[1], r[2] is not None, r[2] or 0, r[3], r[4]) for r in found)
    cuts = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []

    @F.pandas_udf("int")
    def range_of(urlkey: pd.Series, time: pd.Series, page: pd.Series, archive: pd.Series, offset: pd.Series) -> pd.Series:
        rows = zip(urlkey, time, page, archive, offset)
        return pd.Series([bisect_right(cuts, (u, t, not pd.isna(p), 0 if pd.isna(p) else int(p), a, o)) for u, t, p, a, o in rows], dtype="int32")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = {}, None

        def out():
            entries_, at = list(LoserTree(list(held.values()))), 0
            while at < len(entries_):
                part = entries_[at: at + 5_000]
                made = _table(part, pa.array(range(at, at + len(part)), pa.int64()), "place")
                yield made.append_column("range", pa.array([now] * len(part), pa.int32()))
                at += len(part)

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in NAMES]
            for key, entry in zip(batch.column("range").to_pylist(), zip(*columns)):
                if key != now:
                    yield from out() if held else ()
                    held, now = {}, key
                held.setdefault(entry[7], []).append(entry)
        yield from out() if held else ()

    placed = entries.withColumn("range", range_of(*order))
    dealt = placed.repartition("range").sortWithinPartitions("range", "archive", "place")
    return dealt.mapInArrow(merge, ENTRY + ", place bigint, range int")


def capture_index(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the pages as archives to the shared folder, reads them back and merges their index."""
    spark = pages.sparkSession
    folder = run_folder(spark, "archives")
    write_archives(pages, folder, least)
    return merged_index(stored(runs(spark, folder), "runs"))
