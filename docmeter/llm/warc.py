"""WARC archives with revisit records, and a globally ordered capture index by external merge.

Writing: one record a row, through Spark's own text writer and committer, so any
file system will do. Record separators are the writer's line separator, which
makes each part file a WARC file. Files aren't compressed unless asked for, so offset
and length in the index are bytes to be read from the file as it stands (compressed as
a whole, they count its uncompressed bytes). Of records with equal payloads of at
least ``least_bytes`` the one with the largest id is a response, the others are
revisits of it without payload. Rows meet the leaders of repeated digests, by a
broadcast where those are few, else through a shuffle of the payloads.

Index: each archive is read back and parsed by its Content-Length fields; its
captures, sorted by URL key, time and id, are one run. Passes merge up to ``FAN_IN`` runs
of a group into one longer run, until so few are left that the last pass can merge all.
In a pass a group is cut into key ranges, and a task merges one by a loser tree over
the runs' blocks, which come in the order of their first keys: it holds about one block a
run, however long the range. Split keys come from a bounded sample of all keys; they
affect balance only, not the order. A URL captured without end spreads over ranges
too, since time and id are part of the key.

Defined results: null payloads are empty; a null URL has the empty key; rows with
a null id are responses unless an equal payload has an id. All rows that carry
the largest id (repeated rows) are responses. Only id, URL, payload and time
columns are used, so other columns never clash.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from base64 import b32encode
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import urlsplit
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmeter.llm.common import md5_key, scratch_path, table, written

CRLF = "\r\n"
#: Bytes of records that a file should hold, and must not exceed unless one record does.
FILE_BYTES, MOST_FILE_BYTES = 8 << 20, 128 << 20
RANGE_ROWS = 50_000
#: Ranges of a pass at most, and sampled keys for each; beyond, ranges are longer but tasks hold no more.
MOST_RANGES, SAMPLES_A_RANGE = 10_000, 20
#: Runs that a loser tree merges, and captures of one in a block.
FAN_IN, BLOCK_ROWS = 64, 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: First capture time where the rows have none; each id comes a second later.
EPOCH = 1_704_067_200


def base32_sha1(column: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string's UTF-8 bytes, on the JVM."""
    hexed = F.sha1(F.encode(column, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def payloads(pages: DataFrame, key: str, url: str, payload: str, captured: Column | None) -> DataFrame:
    """id, url, when, body, bytes, digest of each row."""
    if captured is None:
        captured = F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col(key), F.lit(0)).cast("long"), F.lit(1_000_000_000)))
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), captured.alias("when"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"))
    return rows.select("*", F.octet_length("body").cast("long").alias("bytes"), base32_sha1(F.col("body")).alias("digest"))


def repeated_payloads(rows: DataFrame, least_bytes: int) -> DataFrame:
    """digest, bytes, leader: payloads of several rows and the largest id among them."""
    found = rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.max("id").alias("leader"), F.count(F.lit(1)).alias("n"))
    return found.where("n > 1").drop("n")


def with_revisits(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    """The rows with type and refers. Leaders are a written table: Spark sends them to the payloads where its own size check allows that."""
    rows = rows.join(leaders, ["digest", "bytes"], "left")  # AQE splits a digest that many rows share
    first = F.col("leader").isNull() | F.col("leader").eqNullSafe(F.col("id"))
    return rows.withColumn("type", F.when(first, "response").otherwise("revisit")).withColumn("refers", F.when(~first, F.col("leader"))).drop("leader")


def _record_id(key: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def records(rows: DataFrame) -> DataFrame:
    """One string column ``value``: a WARC record without the blank lines after it. rows: id, url, when, body, bytes, digest, type, refers."""
    when = F.concat(F.date_format("when", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    clean_url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(F.col("type") == "response", F.col("body")).otherwise(""))
    revisit = F.when(
        F.col("type") == "revisit",
        F.concat(F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), _record_id(F.col("refers")), F.lit(f"{CRLF}X-Refers-To-Page: "), F.col("refers").cast("string"), F.lit(CRLF)),
    ).otherwise("")
    page = F.when(F.col("id").isNull(), "").otherwise(F.concat(F.lit("X-Page: "), F.col("id").cast("string"), F.lit(CRLF)))
    fields = [
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.col("type"), F.lit(f"{CRLF}WARC-Record-ID: "), _record_id(F.col("id")),
        F.lit(f"{CRLF}WARC-Date: "), when, F.lit(f"{CRLF}WARC-Target-URI: "), clean_url,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF), page, revisit,
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length("block").cast("string"), F.lit(CRLF * 2), F.col("block"),
    ]
    return rows.withColumn("block", block).select(F.concat(*fields).alias("value"))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", captured: Column | None = None, least_bytes: int = 0, compression: str = "none") -> None:
    """Writes WARC files under ``path``. Payloads are read twice: for their digests and sizes, and to be written."""
    rows = payloads(pages, key, url, payload, captured)
    known = written(rows.select("id", "bytes", "digest"), "payload-digests")
    leaders = written(repeated_payloads(known, least_bytes), "repeated-payloads")
    sizes = known.agg(F.avg("bytes"), F.max("bytes")).first()
    mean, largest = (sizes[0] or 0) + 700, (sizes[1] or 0) + 700
    per_file = max(1, min(int(FILE_BYTES / mean), MOST_FILE_BYTES // largest))
    records(with_revisits(rows, leaders)).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", per_file).option("compression", compression).text(path)


def url_key(url: str) -> str:
    """Sort-friendly form: reversed host, path and query; scheme, www, default port and fragment dropped."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", host)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + (parts.path.lower() or "/")
    return key + (f"?{'&'.join(sorted(parts.query.lower().split('&')))}" if parts.query else "")


def parse_archive(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields and body of each record; lengths come from the records, never from separators."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if head < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:head].decode("utf-8").split(CRLF)
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        end = head + 4 + int(fields["Content-Length"])
        yield at, end - at, fields, data[head + 4 : end]
        at = end + 4


_ENTRY = "sort_key string, url_key string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"
_NAMES = [x.split()[0] for x in _ENTRY.split(", ")]
_KINDS = [pa.int64() if x.endswith("long") else pa.string() for x in _ENTRY.split(", ")]
_RUNS = f"run string, {_ENTRY}"


def capture(archive: str, offset: int, length: int, fields: dict[str, str], body: bytes) -> tuple:
    """An index entry; raises where a stored payload isn't what its digest says."""
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload), b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
        raise ValueError(f"damaged record at byte {offset} of {archive}")
    key, when = url_key(fields.get("WARC-Target-URI", "")), re.sub(r"\D", "", fields["WARC-Date"])
    page = int(fields["X-Page"]) if "X-Page" in fields else None
    refers = int(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None
    order = f"{key}\x00{when}\x00{(page if page is not None else -(1 << 63)) + (1 << 63):020d}\x00{archive}\x00{offset:012d}"
    return order, key, when, page, size, digest, kind, refers, archive, offset, length


def sorted_runs(spark: SparkSession, path: str) -> DataFrame:
    """Every capture of the archives under ``path``; the captures of an archive stand together, in order: a run."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive = batch.column(0)[i].as_py().rsplit("/", 1)[-1]
                data = batch.column(1)[i].as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                found = sorted((capture(archive, *r) for r in parse_archive(data)), key=lambda e: e[0].encode())
                for k in range(0, len(found), BLOCK_ROWS):
                    part = found[k : k + BLOCK_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([archive] * len(part)), *[pa.array(c, k) for c, k in zip(zip(*part, strict=True), _KINDS, strict=True)]], names=["run", *_NAMES])

    return written(files.mapInArrow(run, _RUNS), "capture-runs")


class LoserTree:
    """k-way merge: inner nodes keep losers, so a pop replays one path of log k matches."""

    def __init__(self, streams: list[Iterator[tuple[bytes, object]]]):
        self.streams, self.k = streams, max(1, len(streams))
        self.heads = [next(s, None) for s in streams] or [None]
        self.losers = [-1] * self.k
        self.winner = self._build(1) if self.k > 1 else 0

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x[0], a) < (y[0], b))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        w, self.losers[node] = (a, b) if self._less(a, b) else (b, a)
        return w

    def __iter__(self) -> Iterator[object]:
        while (head := self.heads[self.winner]) is not None:
            yield head[1]
            w = self.winner
            self.heads[w] = next(self.streams[w], None)
            node = (w + self.k) // 2
            while node:
                if self._less(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merged_order(streams: list[list[tuple[bytes, int]]], fan_in: int) -> list[int]:
    """Numbers of the streams' (key, number) in the order of keys, at most ``fan_in`` streams to a tree."""
    while len(streams) > 1:
        streams = [list(LoserTree([iter([(e[0], e) for e in s]) for s in streams[k : k + fan_in]])) for k in range(0, len(streams), fan_in)]
    return [number for s in streams for _, number in s]


def merged_blocks(blocks: Iterator[tuple[str, str, pa.RecordBatch]], fan_in: int) -> Iterator[pa.RecordBatch]:
    """Captures in order from (run, first key, block) in the order of first keys.

    Whatever stands before the next block's first key is merged when that block comes, so each run keeps
    about a block. More runs than ``fan_in`` are merged that many at a time.
    """
    held: dict[str, tuple[pa.RecordBatch, list[bytes]]] = {}

    def emptied(limit: bytes | None) -> Iterator[pa.RecordBatch]:
        parts, streams, at = [], [], 0
        for run, (block, keys) in list(held.items()):
            n = len(keys) if limit is None else bisect_left(keys, limit)
            if n:
                parts.append(block.slice(0, n))
                streams.append([(k, at + i) for i, k in enumerate(keys[:n])])
                at += n
                held[run] = block.slice(n), keys[n:]
            if n == len(keys):
                del held[run]
        if parts:
            order = pa.array(merged_order(streams, fan_in), pa.int64())
            yield pa.Table.from_batches(parts).combine_chunks().take(order).combine_chunks().to_batches()[0]

    for run, first, block in blocks:
        yield from emptied(first.encode())
        keys = [k.encode() for k in block.column("sort_key").to_pylist()]
        if run in held:  # equal keys at a block's end
            kept, had = held[run]
            block, keys = pa.Table.from_batches([kept, block]).combine_chunks().to_batches()[0], had + keys
        held[run] = block, keys
    yield from emptied(None)


def _blocks(runs: DataFrame, groups: int, splits: list[bytes]) -> DataFrame:
    """group_no, range_no, run, first, block: a run's captures of one range, at most ``BLOCK_ROWS``, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, keys = batch.column(0).to_pylist(), [k.encode() for k in batch.column(1).to_pylist()]
            place = [bisect_right(splits, k) for k in keys]
            rows = batch.drop_columns(["run"])
            out: list[tuple] = []
            start = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or place[i] != place[start] or names[i] != names[start] or i - start >= BLOCK_ROWS or keys[i] < keys[i - 1]:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                        w.write_batch(rows.slice(start, i - start))
                    out.append((crc32(names[start].encode()) % groups, place[start], names[start], keys[start].decode(), sink.getvalue().to_pybytes()))
                    start = i
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary()), strict=True)], names=["group_no", "range_no", "run", "first", "block"])

    return runs.mapInArrow(run, "group_no int, range_no int, run string, first string, block binary")


def merge_pass(runs: DataFrame, groups: int, splits: list[bytes], fan_in: int) -> DataFrame:
    """The captures with group_no, range_no and place (gapless from 0 in a range), each group and range in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield tuple(batch.column(k)[i].as_py() for k in range(5))

        for (group, number), part in groupby(rows(), key=lambda r: r[:2]):
            at = 0
            blocks = ((name, first, next(iter(pa.ipc.open_stream(block)))) for _, _, name, first, block in part)
            for block in merged_blocks(blocks, fan_in):
                n = block.num_rows
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array([group] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())], names=[*_NAMES, "group_no", "range_no", "place"])
                at += n

    dealt = _blocks(runs, groups, splits).repartition(min(MOST_RANGES, groups * (len(splits) + 1)), "group_no", "range_no").sortWithinPartitions("group_no", "range_no", "first", "run")
    return dealt.mapInArrow(run, f"{_ENTRY}, group_no int, range_no int, place long")


def split_keys(runs: DataFrame, total: int, n: int) -> list[bytes]:
    """At most n - 1 keys that cut all captures into ranges about alike, from a sample by hash."""
    want = n * SAMPLES_A_RANGE
    share = min(1.0, 3.0 * want / max(total, 1))
    sample = runs.select("sort_key").where(F.conv(F.substring(md5_key("sort_key"), 1, 7), 16, 10).cast("double") < share * 16**7)
    keys = sorted(r[0].encode() for r in sample.limit(4 * want).collect())  # at most 80 a range
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """All captures in global order: by range_no, then place (gapless from 0 in a range)."""
    total, many = runs.agg(F.count(F.lit(1)), F.count_distinct("run")).first()
    n = max(1, min(-(-total // range_rows), MOST_RANGES))
    n = max(n, min(total // 1000, runs.sparkSession.sparkContext.defaultParallelism))
    splits = split_keys(runs, total, n) if n > 1 else []
    while many > fan_in:
        many = -(-many // fan_in)
        some = max(1, n // many)  # a group's ranges hold about as much as the last pass's
        passed = merge_pass(runs, many, [splits[len(splits) * i // some] for i in range(1, some)] if splits else [], fan_in)
        runs = written(passed.select(F.col("group_no").cast("string").alias("run"), *_NAMES), "merged-runs")
    return merge_pass(runs, 1, splits, fan_in).drop("sort_key", "group_no")


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: archives of all ``pages`` written, read back and merged into one index."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    merged = merge_runs(sorted_runs(spark, path))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "timestamp")
