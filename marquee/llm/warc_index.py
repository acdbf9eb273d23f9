"""WARC archives with revisits, and their capture index merged from sorted runs.

``write_archives`` writes a record per capture through Spark's text writer,
whose line separator is WARC's record end; so archives go to any file system
Spark knows, and a lost executor's file is written again by the committer.
``read_runs`` reads archives back, checks digests, and gives one locally
sorted run of index entries per archive.  ``merge_runs`` deals all runs out by
ranges of (URL key, time, id), also inside one URL's captures, and each task
merges its slices of the k runs with a loser tree; partitions follow each other
in order, so the result is one globally sorted capture history.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path, stage

from .common import bound_batches

CRLF = "\r\n"
RECORDS_PER_ARCHIVE = 20_000
#: An archive's text is about this long at most (its records' mean size is what sets their number).
ARCHIVE_BYTES = 1 << 28
#: Index entries that a task merges, about 1 kB each in its worker.
ENTRIES_PER_RANGE = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = (
    "run string, pos long, url_key string, captured string, page_id long, record_type string,"
    " refers_to long, payload_bytes long, payload_digest string, record_at long, record_bytes long"
)
NAMES = [c.split()[0] for c in ENTRY.split(", ")]


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits make four base32 digits."""
    sha = F.sha1(payload)
    digits = F.concat(
        *(
            F.lpad(F.conv(F.substring(sha, 5 * i + 1, 5), 16, 32), 4, "0")
            for i in range(8)
        )
    )
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(
    captures: DataFrame,
    path: str,
    page: str = "page_id",
    url: str = "url",
    payload: str = "html",
    captured: str = "captured",
    min_bytes: int = 0,
) -> None:
    """Write a record per row of ``captures`` as gzipped archives below ``path``.

    ``captured`` is a timestamp.  Among captures of equal payload (in UTF-8) of at least
    ``min_bytes`` the one with the largest id is a response and the others are revisits of it;
    smaller payloads are all responses.  A null payload is empty, a null URL or time leaves its
    header out, a null id makes a record without number: a revisit if another capture has its
    payload and an id, else a response.  Rows that repeat the largest id are responses each.
    Other columns are ignored; an empty table makes archives without records.
    """
    rows = captures.select(
        F.col(page).cast("long").alias("id"),
        F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.date_format(F.col(captured), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    ).select("*", F.octet_length("payload").alias("n"), base32_sha1(F.col("payload")).alias("digest"))
    shared = (
        rows.filter(F.col("n") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("digest", "first")
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("n").cast("string"),
        F.lit(CRLF * 2),
    )
    revisits = F.coalesce(F.col("first") != F.coalesce("id", F.col("first") - 1), F.lit(False))

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    block = F.when(F.col("again"), F.col("http")).otherwise(F.concat("http", "payload"))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        header("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        F.lit("WARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("id").cast("string"), F.lit("")),
        F.lit(f">{CRLF}"),
        header("WARC-Date", F.col("at")),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(
            F.col("again"),
            F.concat(
                header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), "first", F.lit(">"))),
                header("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        header("Content-Length", F.octet_length("block").cast("string")),
        F.lit(CRLF),
        "block",
    )
    mean = rows.agg(F.avg("n")).first()[0] or 0
    records = max(1, min(RECORDS_PER_ARCHIVE, int(ARCHIVE_BYTES / (mean + 1000))))
    (
        rows.join(shared, "digest", "left")
        .withColumns({"again": revisits & (F.col("n") >= min_bytes), "http": http})
        .withColumn("block", block)
        .select(record.alias("value"))
        .write.option("lineSep", CRLF * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records)
        .text(path)
    )


def url_key(url: str | None) -> str:
    """Host labels from the top domain down, then path and query: ``org,example)/a?b``."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = rest[:cut].lower().split(":", 1)[0].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:] or "/")


class _Reader:
    """Bytes of a gzipped archive, decompressed as they are asked for."""

    def __init__(self, data: memoryview, step: int = 1 << 20):
        self.data, self.step, self.at = data, step, 0
        self.zip = zlib.decompressobj(31)
        self.held = bytearray()
        self.done = 0  # bytes handed out

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        piece = self.data[self.at : self.at + self.step]
        self.at += len(piece)
        self.held += self.zip.decompress(piece)
        while self.zip.eof and (self.zip.unused_data or self.at < len(self.data)):
            left, self.zip = self.zip.unused_data, zlib.decompressobj(31)
            if not left:
                break
            self.held += self.zip.decompress(left)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held:
                    raise ValueError("the archive ends inside a record")
                return None
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.done += n
        return out


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def archive_entries(data: memoryview) -> Iterator[tuple]:
    """(url_key, captured, page_id, type, refers_to, bytes, digest, offset, length) per record.

    Offsets count uncompressed bytes.  Raises where a response's payload has another digest.
    """
    read = _Reader(data)
    while True:
        at = read.done
        head = read.until(b"\r\n\r\n")
        if head is None:
            return
        version, *lines = head.decode()[:-4].split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record starts at {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = read.take(int(fields["Content-Length"]))
        if read.take(4) != b"\r\n\r\n":
            raise ValueError(f"the record at {at} has no end")
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response":
            size = len(payload)
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"the payload of the record at {at} is damaged")
        else:
            size = int(http.rpartition(b"Content-Length: ")[2])
        yield (
            url_key(fields.get("WARC-Target-URI")),
            fields.get("WARC-Date", ""),
            _number(fields["WARC-Record-ID"]),
            fields["WARC-Type"],
            _number(fields.get("WARC-Refers-To")),
            size,
            digest,
            at,
            read.done - at,
        )


def _order(url: str, captured: str, page: int | None) -> tuple:
    return url, captured, page is not None, page or 0


def _batches(rows: Iterator[tuple], size: int = 10_000) -> Iterator:
    import pyarrow as pa

    def batch(rows):
        kinds = [pa.int64() if c.endswith(" long") else pa.string() for c in ENTRY.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=NAMES
        )

    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below ``path``: each archive is one sorted run."""

    def scan(batches: Iterator) -> Iterator:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                entries = sorted(
                    archive_entries(memoryview(content.as_buffer())), key=lambda e: _order(*e[:3])
                )
                yield from _batches((name, i, *e) for i, e in enumerate(entries))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(scan, ENTRY)


class LoserTree:
    """Merges k sorted iterators: every inner node keeps the loser of its match."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.heads = [self._pull(i) for i in range(len(runs))] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._replay(i)

    def _pull(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (self.key(row), i, row)

    def _beats(self, i: int, j: int) -> bool:
        x, y = self.heads[i], self.heads[j]
        return x is not None and (y is None or x[:2] < y[:2])

    def _replay(self, i: int) -> None:
        """Play from leaf i up; while the tree is built, the first to come to a node waits there."""
        node = (i + self.k) // 2
        while node > 0:
            j = self.losers[node]
            if j < 0:
                self.losers[node] = i
                return
            if self._beats(j, i):
                self.losers[node], i = i, j
            node //= 2
        self.losers[0] = i

    def __iter__(self):
        while (won := self.heads[self.losers[0]]) is not None:
            yield won[2]
            i = self.losers[0]
            self.heads[i] = self._pull(i)
            self._replay(i)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All entries in global order of URL key, time and id; ``part`` and ``rank`` number them.

    The ranges follow the number of entries, about ``ENTRIES_PER_RANGE`` each, and a task holds the
    slices of one range, so its memory does not grow with the index.  ``runs`` is read three times
    (counted, sampled for the ranges, merged).
    """

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                slices.setdefault(row[0], []).append(row)
        for rows in slices.values():
            rows.sort(key=lambda r: r[1])  # in order already, but for how blocks arrived
        tree = LoserTree(
            [iter(slices[k]) for k in sorted(slices)], key=lambda r: _order(r[2], r[3], r[4])
        )
        part, rank = TaskContext.get().partitionId(), 0
        for batch in _batches(iter(tree)):
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(rank, rank + n), pa.int64())],
                names=[*NAMES, "part", "rank"],
            )
            rank += n

    least = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-runs.count() // ENTRIES_PER_RANGE))
    return runs.repartitionByRange(ranges, "url_key", "captured", "page_id").mapInArrow(
        merge, ENTRY + ", part int, rank long"
    )


def capture_history(captures: DataFrame, **columns) -> DataFrame:
    """Write archives to the shared folder, read them back, and merge their index."""
    spark = captures.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, "archives")
    write_archives(captures, path, **columns)
    return merge_runs(stage(read_runs(spark, path), "runs"))
