"""WARC archives of pages, read back through an index merged from sorted runs.

A page is a `response` record or, if an earlier page has the same payload, a `revisit`
of it. Each record is a gzip member of its own, so it can be read by its place in the
file alone. The files are written by Spark to the shared folder, then parsed member by
member, checked against their digests, and give one run of index entries each, sorted by
url key and time. The runs are dealt to key ranges of a bounded number of entries, and each
range merges its parts of all runs with a loser tree, so the ranges together hold every
url's captures in global order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm.common import slices, store, table
from trilayer.sinks.scratch import scratch_dir

#: Payloads of fewer bytes are always stored whole.
LEAST_REVISIT_BYTES = 100
#: Payload bytes a file holds on average, before compression.
FILE_BYTES = 16 << 20
RECORD_END = "\r\n\r\n"
#: Bytes of a record in one gzip member. The last byte of a member, the highest of its size, is
#: then 0: the text writer, whose lines must end in something, is given the members without it.
MEMBER_BYTES = 8 << 20
#: Bytes of a file that are looked at a time for the end of a member.
_WINDOW = 1 << 16
#: Index entries that a range holds, about.
RANGE_ENTRIES = 200_000
#: Seconds up to the year 10000: dates have four digits for the year.
_DATES = 253_402_300_800
ENTRY = (
    "url_key string, captured_at string, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, file string, offset long, length long, run long"
)
_FIELDS = [f.split()[0] for f in ENTRY.split(", ")]


def classified(pages: DataFrame, captured_at: Column) -> DataFrame:
    """Pages with payload, digest, record_type and refers_to."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        captured_at.alias("captured_at"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(F.encode(payload, "UTF-8"), 256).alias("digest"),
    )
    long_enough = F.col("payload_bytes") >= LEAST_REVISIT_BYTES
    firsts = (
        rows.filter(long_enough)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "first")
    )
    revisits = long_enough & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        *rows.columns,
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first")).alias("refers_to"),
    )


def record_text(block: Column, http: Column) -> Column:
    """A whole WARC record."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def name_of(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.concat(
        line("WARC-Refers-To", name_of(F.col("refers_to"))),
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
    )
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name_of(F.col("page_id"))),
        line("WARC-Target-URI", uri),
        line("WARC-Date", F.col("captured_at")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("record_type") == "revisit", revisit).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", (F.octet_length(http) + F.octet_length(block)).cast("string")),
        F.lit("\r\n"), http, block, F.lit(RECORD_END),
    )


def write_archives(records: DataFrame, path: str, rows_per_file: int) -> None:
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise("")
    lines = records.select(record_text(block, http).alias("value")).mapInArrow(_members, "value binary")
    # Bytes as they are: a cast to text checks nothing, and the writer adds the byte left out.
    lines = lines.select(F.col("value").cast("string").alias("value"))
    lines.write.options(lineSep="\x00", maxRecordsPerFile=rows_per_file).text(path)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 64):
        packed = []
        for record in batch.column(0):
            raw = record.as_py().encode("utf-8", "replace")
            whole = b"".join(
                zlib.compress(raw[i : i + MEMBER_BYTES], wbits=31) for i in range(0, len(raw), MEMBER_BYTES)
            )
            packed.append(whole[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["value"])


def members_of(data: bytes, at: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and content of the gzip members of a file, from a place on."""
    view = memoryview(data)
    while at < len(data):
        start, parts, reader = at, [], zlib.decompressobj(wbits=31)
        while not reader.eof:
            some = view[at : at + _WINDOW]
            if not some:
                raise ValueError(f"the member at byte {start} is cut off")
            parts.append(reader.decompress(some))
            at += len(some) - len(reader.unused_data)
        yield start, at, b"".join(parts)


def parse_archive(data: bytes, at: int = 0) -> Iterator[tuple[dict[str, str], int, int, bytes]]:
    """Headers, place, length in the file and block of each record; the length in its head,
    not a separator, tells where a record ends."""
    held, start = b"", at
    for first, end, part in members_of(data, at):
        if not held:
            start = first
        held += part
        head = held.find(b"\r\n\r\n")
        if not held.startswith(b"WARC/1.1\r\n") or head < 0:
            raise ValueError(f"no record at byte {start}")
        lines = held[:head].decode("utf-8", "replace").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = head + 4 + int(headers["Content-Length"])
        if len(held) >= size + len(RECORD_END):
            yield headers, start, end - start, held[head + 4 : size]
            held = b""
    if held:
        raise ValueError(f"the record at byte {start} is cut off")


def read_record(spark: SparkSession, path: str, file: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record by its place, as the index gives it."""
    content = F.substring("content", F.lit(offset + 1), F.lit(length))
    found = spark.read.format("binaryFile").load(f"{path}/{file}").select(content.alias("member")).first()
    headers, _, _, block = next(parse_archive(bytes(found["member"])))
    return headers, block.partition(b"\r\n\r\n")[2]


def url_key(url: str) -> str:
    """Host labels in reverse, then the rest, without scheme: captures of a site sort together."""
    rest = url.split("://", 1)[-1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:].split("#")[0]


def index_entry(headers: dict[str, str], offset: int, size: int, block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")

    def page(name: str) -> int | None:
        number = headers.get(name, "")[len("<urn:page:") : -1]
        return int(number) if number else None

    return (
        url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], page("WARC-Record-ID"),
        length, digest, kind, page("WARC-Refers-To"), offset, size,
    )


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[-2]


def archive_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives; those of one file are one run, sorted."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                file = name.as_py().rsplit("/", 1)[-1]
                run = int.from_bytes(hashlib.sha256(file.encode()).digest()[:7], "big")
                entries = sorted((index_entry(*r) for r in parse_archive(content.as_py())), key=_order)
                if entries:
                    *rows, offsets, sizes = zip(*entries)
                    yield _batch([*rows, [file] * len(offsets), offsets, sizes, [run] * len(offsets)])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(runs, ENTRY)


def _batch(columns: list) -> pa.RecordBatch:
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _FIELDS)


class LoserTree:
    """Merges sorted runs; each inner node remembers the loser of its match."""

    def __init__(self, runs: Iterable[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [self._take(i) for i in range(len(self.runs))]
        self.size = max(1, len(self.runs))
        self.losers = [-1] * self.size
        for leaf in range(len(self.runs)):
            self._replay(leaf, building=True)

    def _take(self, run: int) -> tuple | None:
        entry = next(self.runs[run], None)
        return None if entry is None else (_order_of_row(entry), entry)

    def _wins(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) <= (y[0], b))

    def _replay(self, winner: int, building: bool = False) -> None:
        node = (winner + self.size) // 2
        while node:
            other = self.losers[node]
            if building and other < 0:
                self.losers[node] = winner
                return
            if self._wins(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and (head := self.heads[winner := self.losers[0]]) is not None:
            yield head[1]
            self.heads[winner] = self._take(winner)
            self._replay(winner)


def _order_of_row(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[7]


def merge_runs(entries: DataFrame) -> DataFrame:
    """Entries in global order of url key, time and page: ranges of it, merged run by run."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                runs.setdefault(row[-1], []).append(row)
        for rows in batched(LoserTree(runs.values()), 8192):
            yield _batch(list(zip(*rows)))

    # Time, page and place split a url however often it was captured. Spark sorts each run's
    # part, on disk where it must, as fetches of a shuffle come in any order.
    order = ["url_key", "captured_at", "page_id", "file", "offset"]
    ranges = -(-max(entries.count(), 1) // RANGE_ENTRIES)
    ranged = entries.repartitionByRange(ranges, *order).sortWithinPartitions("run", *order)
    return ranged.mapInArrow(merged, ENTRY)


def archive_pages(pages: DataFrame, captured_at: Column | None = None, path: str | None = None) -> DataFrame:
    """Write a record per page to `path`, read the archives back, and return the merged index.

    One row per page: the columns of `ENTRY`. Null html is an empty payload, a null url
    an empty target. Of equal payloads of `LEAST_REVISIT_BYTES` or more the smallest
    page_id is the response; rows that repeat that id are responses too. A null page_id
    revisits any other. Without `captured_at` a page was captured page_id seconds after the
    epoch, counted round from the year 10000 to it, so any 64-bit id has a date. An empty
    table gives no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    seconds = F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(_DATES))
    when = captured_at if captured_at is not None else F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    size = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)))).first()[0] or 0
    write_archives(classified(pages, when), path, max(1, int(FILE_BYTES / max(size, 1024))))
    return merge_runs(store(archive_runs(spark, path), "index-runs"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = archive_pages(table(spark, sf_dir, "pages"))
    return merged.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at"
    )


OP4_SQL = """
with payloads as (
  select page_id, url, coalesce(html, '') as payload from pages
), firsts as (
  select *, min(page_id) over (partition by payload) as first from payloads
), records as (
  select page_id, url, strlen(payload) as payload_bytes, sha256(payload) as payload_digest,
    case when strlen(payload) >= 100 and page_id <> first then first end as refers_to
  from firsts
), parts as (
  select *, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else coalesce(url, '') end as rest
  from records
)
select page_id, payload_bytes, payload_digest,
  case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to,
  array_to_string(list_reverse(string_split(lower(regexp_extract(rest, '^([^/?#]*)', 1)), '.')), ',')
    || ')' || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as url_key,
  strftime(make_timestamp(page_id * 1000000), '%Y-%m-%dT%H:%M:%SZ') as captured_at
from parts
"""
